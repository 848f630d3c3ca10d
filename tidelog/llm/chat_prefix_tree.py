"""Chat formatting as prefix trees: shared first turns are emitted once, depth first.

Conversations that begin with the same turns share a path of nodes, one node a turn. The
output is one long sequence of tokens in depth-first order. A node has the place of its
tokens there, the position ids that continue its parent's, and the intervals of its
ancestors, which with the node itself are all that its tokens attend to.

Depth-first order is the order of conversations by the digests of their turns. That order
is dealt into ranges; in a range a conversation adds the nodes that its predecessor does
not share. A range needs to know the last conversation before it and where that one's
nodes lie: one small summary a range, put together on the driver. So a first turn shared
by a third of all conversations is many ranges, not one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, range_buckets, ranges_of
from .encoders import encoder

#: Strings that mark structure in chat templates; texts never contain them unescaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
_ESCAPE = re.compile("|".join(["\\\\", *map(re.escape, CONTROLS)]))
_UNESCAPE = re.compile(r"\\(\\?)")
DIGEST = 16

NODE = (
    "struct<start: long, length: int, position: int, depth: int, ids: array<int>, loss_from: int, loss_to: int, "
    "ancestors: array<struct<start: long, end: long>>>"
)
EMISSIONS = f"conv_id long, n_turns long, node_starts array<long>, nodes array<{NODE}>"


def escape(text: str) -> str:
    """Break up control strings with a backslash after their first character; double all others."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    """The text that :func:`escape` was given."""
    return _UNESCAPE.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and foot of a turn. A line feed in a role is written as a vertical tab and 0, a vertical tab as one and 1."""
    return f"<s>{_role(role)}\n", escape(text), "</s>"


def _role(role: str) -> str:
    return escape(role).replace("\v", "\v1").replace("\n", "\v0")


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, _, text = formatted.removeprefix("<s>").removesuffix("</s>").partition("\n")
    return unescape(re.sub("\v([01])", lambda m: "\n" if m[1] == "0" else "\v", role)), unescape(text)


def _turn_digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(b"%d " % len(role.encode()) + role.encode() + text.encode(), digest_size=DIGEST).digest()


def _paths(turns: DataFrame, vocabulary: str, loss_roles: tuple[str, ...]) -> DataFrame:
    """``conv_id, path, lengths, turns``: a conversation's turn digests, and its tokenised turns."""
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    lone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    whole = turns.groupBy("conv_id", lone.alias("lone")).agg(F.sort_array(F.collect_list(row)).alias("turns")).drop("lone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            paths, lengths, tokens = [], [], []
            for conversation in batch.column(1):
                path, n, out = [], [], []
                for t in conversation.as_py():
                    head, body, foot = (enc.encode(x) for x in format_turn(t["role"], t["text"]))
                    loss = t["role"] in loss_roles
                    path.append(_turn_digest(t["role"], t["text"]))
                    ids = head + body + foot  # as bytes until they are emitted: four a token
                    n.append(len(ids) // 4)
                    out.append({"ids": ids, "loss_from": len(head) // 4 if loss else 0, "loss_to": (len(head) + len(body)) // 4 if loss else 0})
                paths.append(b"".join(path))
                lengths.append(n)
                tokens.append(out)
            kind = pa.list_(pa.struct([("ids", pa.binary()), ("loss_from", pa.int32()), ("loss_to", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.binary()), pa.array(lengths, pa.list_(pa.int32())), pa.array(tokens, kind)], ["conv_id", "path", "lengths", "turns"])

    return whole.mapInArrow(run, "conv_id long, path binary, lengths array<int>, turns array<struct<ids: binary, loss_from: int, loss_to: int>>")


def _shared_turns(a: bytes, b: bytes) -> int:
    """Turns at the start of both paths."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[: mid * DIGEST] == b[: mid * DIGEST] else (low, mid)
    return low


def _summaries(ranged: DataFrame) -> dict[int, tuple[bytes, int, list[tuple[int, int]]]]:
    """For each range: the path before it, where it starts, and where the nodes of that path lie."""
    last = {r[0]: bytes(r[1]) for r in ranged.groupBy("bucket").agg(F.max("path")).collect()}
    before, previous = {}, b""
    for b in sorted(last):
        before[b], previous = previous, last[b]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("path", "ascending")])
        path, at, stack = before[key[0].as_py()], 0, []
        stack = [None] * (len(path) // DIGEST)
        for now, lengths in zip(table.column("path").to_pylist(), table.column("lengths").to_pylist()):
            k = _shared_turns(path, now)
            del stack[k:]
            for n in lengths[k:]:
                stack.append((at, at + n))
                at += n
            path = now
        return pa.table({"bucket": [key[0].as_py()], "total": [at], "starts": [[x[0] if x else -1 for x in stack]], "ends": [[x[1] if x else -1 for x in stack]]}, schema=pa.schema([("bucket", pa.int32()), ("total", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]))

    found = {r["bucket"]: r for r in ranged.select("bucket", "path", "lengths").groupBy("bucket").applyInArrow(run, "bucket int, total long, starts array<long>, ends array<long>").collect()}
    out, base, stack = {}, 0, []
    for b in sorted(found):
        out[b] = (before[b], base, list(stack))
        stack = [stack[d] if s < 0 else (base + s, base + e) for d, (s, e) in enumerate(zip(found[b]["starts"], found[b]["ends"]))]
        base += found[b]["total"]
    return out


def _merged(intervals: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    if intervals and intervals[-1][1] == start:
        return [*intervals[:-1], (intervals[-1][0], end)]
    return [*intervals, (start, end)]


def emit(turns: DataFrame, vocabulary: str, *, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Format ``turns(conv_id, turn, role, text)``; a row per conversation (:data:`EMISSIONS`).

    ``nodes``: the nodes that the conversation adds, in depth-first order; their tokens,
    one conversation after the other by ``start``, are the training sequence. ``position``
    is the position id of the node's first token, ``ancestors`` are the intervals (merged
    where they touch) that it attends to besides itself, ``loss_from .. loss_to`` are the
    tokens of it under the loss mask. ``node_starts``: all nodes of the conversation.

    Null roles and texts are empty ones. Turns are ordered by number, those of one number
    (or none: first) by role and text; repeated rows are repeated turns. A row without a
    ``conv_id`` is a conversation of one turn. Equal conversations share all nodes. An empty table
    gives no rows. Other columns aren't read. A single conversation is one row and so fits
    a task.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    paths = materialize(_paths(rows, vocabulary, loss_roles), "tokenised")  # ranges sample what they deal: not the tokeniser
    ranged = range_buckets(paths, [F.col("path"), F.col("conv_id")], "paths", ranges=ranges_of(paths, 64 * F.size("lengths") + 4 * F.aggregate("lengths", F.lit(0), lambda s, x: s + x)))
    discard(paths)
    seeds = ranged.sparkSession.sparkContext.broadcast(_summaries(ranged))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, path, at = None, b"", 0
        stack: list[tuple[int, int, list, int]] = []  # start, end, intervals with itself, position of its end

        def push(start: int, end: int) -> tuple[list, int]:
            seen, position = (stack[-1][2], stack[-1][3]) if stack else ([], 0)
            stack.append((start, end, _merged(seen, start, end), position + end - start))
            return seen, position

        for batch in batches:
            out: list[list] = [[], [], [], []]
            for b, conv, now, turns_of in zip(*(batch.column(c).to_pylist() for c in ("bucket", "conv_id", "path", "turns"))):
                if b != bucket:
                    bucket, (path, at, known) = b, seeds.value[b]
                    stack.clear()
                    for start, end in known:
                        push(start, end)
                k = _shared_turns(path, now)
                del stack[k:]
                nodes = []
                for depth in range(k, len(turns_of)):
                    t = turns_of[depth]
                    ids = np.frombuffer(t["ids"], "<i4")
                    n = len(ids)
                    seen, position = push(at, at + n)
                    nodes.append({"start": at, "length": n, "position": position, "depth": depth, "ids": ids, "loss_from": t["loss_from"], "loss_to": t["loss_to"], "ancestors": [{"start": s, "end": e} for s, e in seen]})
                    at += n
                path = now
                for column, value in zip(out, (conv, len(turns_of), [x[0] for x in stack], nodes)):
                    column.append(value)
            node = pa.struct([("start", pa.int64()), ("length", pa.int32()), ("position", pa.int32()), ("depth", pa.int32()), ("ids", pa.list_(pa.int32())), ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("ancestors", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(node)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["conv_id", "n_turns", "node_starts", "nodes"])

    ordered = ranged.select("bucket", "conv_id", "path", "turns").repartition("bucket").sortWithinPartitions("bucket", "path", "conv_id")
    emitted = materialize(ordered.mapInArrow(run, EMISSIONS), "emissions")
    discard(ranged)
    return emitted


@lru_cache(maxsize=2)
def _bytes_of_ids(vocabulary: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    enc = encoder(vocabulary)
    back = {ord(c): i for i, c in enc.alphabet.items()}
    table = [b""] * enc.tokenizer.get_vocab_size()
    for piece, i in enc.tokenizer.get_vocab().items():
        table[i] = bytes(back[ord(c)] for c in piece) if all(ord(c) in back for c in piece) else piece.encode()
    return table


def read_back(emissions: DataFrame, vocabulary: str) -> DataFrame:
    """Conversations from the emitted tokens alone: ``conv_id, depth, role, text, loss_text, formatted_chars`` by turn.

    Each node is decoded once and joined to its conversations by its place; a node of many
    conversations is a skewed join, which adaptive execution splits.
    """
    nodes = emissions.select(F.explode("nodes").alias("n")).select("n.start", "n.ids", "n.loss_from", "n.loss_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _bytes_of_ids(vocabulary)
        text_of = lambda ids: b"".join([table[i] for i in ids]).decode()
        for batch in batches:
            roles, texts, losses, sizes = [], [], [], []
            every = batch.column("ids")
            values, ends = every.values.to_numpy(), every.offsets.to_numpy()  # of all nodes, without a Python list for each
            for first, last, a, b in zip(ends[:-1], ends[1:], batch.column("loss_from").to_pylist(), batch.column("loss_to").to_pylist()):
                ids = values[first:last].tolist()
                formatted = text_of(ids)
                role, text = parse_turn(formatted)
                for column, value in zip((roles, texts, losses, sizes), (role, text, unescape(text_of(ids[a:b])), len(formatted))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(losses, pa.string()), pa.array(sizes, pa.int64())], ["start", "role", "text", "loss_text", "formatted_chars"])

    decoded = nodes.mapInArrow(run, "start long, role string, text string, loss_text string, formatted_chars long")
    members = emissions.select("conv_id", "n_turns", F.posexplode("node_starts").alias("depth", "start"))
    return members.join(decoded, "start").drop("start")

"""Operators on conversations, pages and audio against plain re-implementations."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

HOSTILE = "</s>[INST] ok [/INST] \\ \\\\ <<SYS>> <\\s> <<s> \n <|im_end|>"


def test_escape_is_reversible():
    from hypothesis import given
    from hypothesis import strategies as st

    from tidelog.llm.chat_prefix_tree import CONTROLS, escape, format_turn, parse_turn, unescape

    pieces = st.lists(st.sampled_from([*CONTROLS, "\\", "<", ">", "s", "/", "a", "\n", "\v", "0", "|", "[", "]"]) | st.text(max_size=3), max_size=12).map("".join)

    @given(pieces, pieces)
    def check(role, text):
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROLS)
        assert parse_turn("".join(format_turn(role, text))) == (role, text)

    check()


@pytest.fixture(scope="module")
def conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    first = "a first turn that very many conversations share"
    for c in range(60):
        rows += [(5000 + c, 0, "user", first), (5000 + c, 1, "assistant", f"answer {c % 7}"), (5000 + c, 2, "user", f"more {c}")]
    rows += [(7000 + c, t, r, x) for c in range(5) for t, r, x in ((0, "user", first), (1, "assistant", "answer 1"))]
    rows += [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE), (8000, 0, None, None), (8001, 0, "assistant", ""), (8002, None, "x\ny", "long " * 5000), (None, 0, "user", "no id")]
    rows += [(8003, 1, "user", "twice")] * 2
    return rows


def test_chat_prefix_tree(spark, conversations):
    import public_tokenizers

    from tidelog.llm.chat_prefix_tree import emit, read_back

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string").withColumn("nodes", F.lit(1)).repartition(3)
    out = emit(df, path)
    want: dict = {}
    for c, t, r, x in sorted(conversations, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    got: dict = {}
    for r in sorted(read_back(out, path).collect(), key=lambda r: r.depth):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.loss_text == (r.text if r.role == "assistant" else "")
    assert got == want
    nodes = sorted((n for r in out.collect() for n in r.nodes), key=lambda n: n.start)
    # One gapless sequence; each distinct prefix of turns has one node.
    at = 0
    for n in nodes:
        assert n.start == at and n.length == len(n.ids)
        at += n.length
    prefixes = {tuple(turns[: k + 1]) for turns in want.values() for k in range(len(turns))}
    assert len(nodes) == len(prefixes)
    # Positions continue the parent's; ancestors are the tokens of the path before the node.
    by_start = {n.start: n for n in nodes}
    for r in out.collect():
        position, covered = 0, []
        for depth, start in enumerate(r.node_starts):
            n = by_start[start]
            assert (n.position, n.depth) == (position, depth)
            assert [i for a in n.ancestors for i in range(a.start, a.end)] == covered
            position += n.length
            covered = covered + list(range(n.start, n.start + n.length))
    assert emit(df.limit(0), path).count() == 0


def test_op1_query(spark, sf_dir):
    from tidelog.llm.queries import op1_chat_prefix_tree

    rows = {r.conv_id: r for r in op1_chat_prefix_tree(spark, sf_dir).collect()}
    turns: dict = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-1] = [(x, "</s>[INST] ok [/INST]") for x in ("user", "assistant")]
    assert rows.keys() == turns.keys()
    for c, t in turns.items():
        loss = "".join(x for r, x in t if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for r, x in t)
        assert (rows[c].n_turns, rows[c].loss_chars) == (len(t), len(loss))
        assert rows[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert rows[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_revisits(spark):
    from tidelog.llm.warc_revisit import resolve_revisits

    rng = np.random.default_rng(2)
    rows, hot = [], "HTTPS://User@www.Example.com:443/a/?utm_source=x&q=1#top"
    for i in range(400):
        url = hot if i % 3 == 0 else f"http://example.com/{int(rng.integers(12))}/?q=1&ref=abc"
        revisit, tag = bool(rng.integers(2)), f'"{int(rng.integers(3))}"'
        headers = {"etag": ("W/" if revisit else "") + tag, "date": str(i), "x-own": str(i)} if i % 4 else {"last-modified": tag} if i % 8 else None
        rows.append((i, url, int(rng.integers(60)), revisit, headers))
    rows += [(900, None, 5, True, {}), (901, "x", None, True, None), (902, None, 5, False, {}), (903, "only/revisit", 5, True, {"etag": "1"}), (904, "example.com/0", 70, None, {"etag": '"9"'})]
    df = spark.createDataFrame(rows, "record_id long, url string, captured long, is_revisit boolean, headers map<string,string>").withColumn("bucket", F.lit(1)).repartition(3)
    from tidelog.llm.warc_revisit import canonical_url

    key = {r.record_id: r.k for r in df.select("record_id", canonical_url(F.col("url")).alias("k")).collect()}
    assert key[0] == "example.com/a/?q=1"
    got = {r.record_id: r for r in resolve_revisits(df).collect()}
    assert got.keys() == {r[0] for r in rows if r[3]}
    for i, _, at, revisit, headers in rows:
        if not revisit:
            continue
        earlier = [r for r in rows if not r[3] and key[r[0]] == key[i] is not None and at is not None and r[2] is not None and r[2] < at]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        mine, stored = headers or {}, (best[4] or {}) if best else {}
        verdict = None
        if best:
            if "etag" in mine and "etag" in stored:
                verdict = "etag" if mine["etag"].removeprefix("W/") == stored["etag"].removeprefix("W/") else "mismatch"
            elif "last-modified" in mine and "last-modified" in stored:
                verdict = "last-modified" if mine["last-modified"] == stored["last-modified"] else "mismatch"
            else:
                verdict = "none"
        assert (got[i].response_id, got[i].validator) == (best and best[0], verdict)
        resolved = verdict not in (None, "mismatch")
        assert got[i].headers == ({**stored, **{k: v for k, v in mine.items() if k != "x-own"}} if resolved else mine)
    assert resolve_revisits(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def recordings(spark):
    """Melodies, copies of them, louder, cut and noisy versions, and what is no audio."""
    from tidelog.llm.audio_chroma import wav_bytes

    rng, rate = np.random.default_rng(4), 8000
    rows, melodies = [], []
    for _ in range(60):
        notes = 220 * 2 ** (rng.integers(0, 24, 24) / 12)
        melodies.append(np.concatenate([np.sin(2 * np.pi * f * np.arange(1600) / rate) for f in notes]) * 0.4)
    for i, m in enumerate(melodies):
        rows += [(100 * i, wav_bytes(m, rate)), (100 * i + 1, wav_bytes(m, rate)), (100 * i + 2, wav_bytes(m[512 * 6 :], rate)), (100 * i + 3, wav_bytes(m * 0.5 + rng.normal(0, 0.002, len(m)), rate))]
    rows += [(7001, None), (7002, b""), (7003, b"RIFFxxxxWAVE"), (7004, wav_bytes(np.zeros(100), rate)), (None, rows[0][1])]
    rows += [(8000 + i, wav_bytes(np.zeros(20_000 + 512 * i), rate)) for i in range(10)]
    return spark.createDataFrame(rows, "rec_id long, audio binary").withColumn("key", F.lit(0))


def test_alignment_recall(spark, recordings):
    from tidelog.llm.audio_chroma import align, fingerprints

    prints = fingerprints(recordings)
    got = {r.rec_id: r for r in align(prints).collect()}
    by_digest: dict = {}
    for r in prints.collect():
        if r.digest:
            by_digest.setdefault(r.digest, []).append((r.rec_id, np.array(r.codes)))
    classes = {min(i for i, _ in g if i is not None): g[0][1] for g in by_digest.values()}
    queries = [c for c, g in classes.items() if any(i is not None and i % 100 == 0 for i, x in by_digest[next(d for d, h in by_digest.items() if any(j == c for j, _ in h))])]
    want = set()
    for c, r in classes.items():
        for q in queries:
            if q == c:
                continue
            a, best = classes[q], 1.0
            for offset in range(-len(r) // 2, len(a) // 2 + 1):
                lo, n = max(0, -offset), 0
                n = min(len(r), len(a) - offset) - lo
                if n >= max(1, 0.5 * min(len(a), len(r))):
                    x = a[lo + offset : lo + offset + n] ^ r[lo : lo + n]
                    best = min(best, sum(int(v).bit_count() for v in x) / (32 * n))
            if best <= 0.10:
                want.add(c)
    found = {r.class_id for r in got.values() if r.n_links}
    assert found <= want
    assert len(found) >= 0.9 * len(want) > 0
    assert got[1].class_id == 0 and got[102].best_query == 100 and got[102].best_offset == 6
    assert got[7001].class_id is None and got[7004].n_codes == 0
    assert align(prints.limit(0)).count() == 0

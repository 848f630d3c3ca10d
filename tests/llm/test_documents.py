"""Operators on documents against plain re-implementations, on a small table with hard cases."""

import math
import re
import zlib
from array import array
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

WORDS = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    """Rows of the test table, and nulls, empty, very long, repeated and odd texts."""
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    base = "one two three four five six seven eight nine ten eleven twelve"
    odd = [
        None, "", " \n\t ", "x", "x y", LONG, LONG + " tail", "  a  b \n c\n\nd  ", "</s><s>[INST] <|endoftext|> <0x41> ▁▁ ▁x",
        "İstanbul ΣΑΣ ﬁ é ½²३ 日本語テキスト 😀\x1c\x1d\x00end", base, base.upper(), base + " thirteen", base.replace("six", "6"), "a b c\r\nd", "\n\n\n",
    ]
    rows += [(10_000 + i, t, None if i % 3 else "xx", None) for i, t in enumerate(odd)]
    rows += [(None, base, "en", "src1"), (None, None, None, None), (20_000, base, "en", "src1"), (20_000, base, "en", "src1")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    # Extra columns whose names clash with those used inside.
    return df.repartition(3).withColumns({c: F.lit(1) for c in ("start", "bucket", "n", "tokens", "digest", "a", "b")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _ids(name, end):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, end]


def test_encoder_equals_library(texts):
    from tidelog.llm.encoders import Encoder

    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc, ref = Encoder(public_tokenizers.path(name)), _ids(name, 7)
        for _, t, *_ in texts:
            assert array("I", enc.encode(t or "")).tolist() == ref(t)[:-1]


def test_packing(docs, texts, empty):
    from tidelog.llm.packing import pack_documents, sequence_lengths

    placed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=256, group_size=20)
    rows, ids = placed.collect(), _ids("word_bpe_49k.json", 1)
    want = Counter()
    for doc, t, *_ in texts:
        all_ids = ids(t)
        for at in range(0, len(all_ids), 256):
            piece = all_ids[at : at + 256]
            want[doc, at, len(piece), zlib.crc32(array("I", piece).tobytes()), len(all_ids)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    used: dict = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 256
    stored = {r.sequence_id: r.stored for r in sequence_lengths(placed, capacity=256).collect()}
    assert all(stored[s] == (n if n & (n - 1) == 0 else 256) for s, n in used.items())
    assert pack_documents(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_first_fit_decreasing_equals_plain_scan():
    import numpy as np

    from tidelog.llm.packing import first_fit_decreasing

    lengths = np.random.default_rng(1).integers(1, 100, 300)
    sequence, offset = first_fit_decreasing(lengths, 100)
    free: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if at == len(free):
            free.append(100)
        assert (sequence[i], offset[i]) == (at, 100 - free[at])
        free[at] -= lengths[i]


def test_token_counts(docs, texts, empty):
    import sentencepiece

    from tidelog.llm.token_counts import count_tokens

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted(((d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t, *_ in texts), key=repr)
    assert _collect(count_tokens(docs, path)) == want
    assert _collect(count_tokens(docs, path, head=40)) == want
    assert count_tokens(empty, path).count() == 0


def _shingles(text, width):
    words = [m.translate({c: c + 32 for c in range(65, 91)}) for m in WORDS.findall(text or "")]
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def _components(rows, width):
    sets = [_shingles(t, width) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least: dict = {}
    for i, (d, *_) in enumerate(rows):
        least[root(i)] = min([x for x in (least.get(root(i)), d) if x is not None], default=None)
    return sorted(((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, *_) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, texts, empty, width):
    from tidelog.llm.hyperminhash import near_duplicates

    assert _collect(near_duplicates(docs, shingle_words=width)) == _components(texts, width)
    assert near_duplicates(empty).count() == 0


def test_near_duplicates_in_chains(spark):
    """Neighbours are linked, distant ones are not; all have one component."""
    from tidelog.llm.hyperminhash import near_duplicates

    words = [f"t{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[8 * k : 8 * k + 120]), "", "") for k in range(30)]
    rows += [(1000 + k, " ".join(words[:60] + [f"u{k}_{j}" for j in range(12)]), "", "") for k in range(40)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert _collect(near_duplicates(df, shingle_words=2)) == _components(rows, 2)


def test_hyperminhash_estimate():
    import numpy as np

    from tidelog.llm.hyperminhash import estimate, registers

    rng = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        got = []
        for _ in range(40):
            union = np.unique(rng.integers(0, 1 << 63, 3000, dtype="u8") * np.uint64(2))
            n = round(share * len(union))
            half = (len(union) - n) // 2
            pick = rng.permutation(len(union))
            a, b = np.sort(union[pick[: n + half]]), np.sort(union[np.concatenate([pick[:n], pick[n + half :]])])
            got.append(estimate(registers(a, 240)[None], registers(b, 240)[None], np.array([len(a)]), np.array([len(b)]))[0][0])
        assert abs(np.mean(got) - share) < 0.02


def test_fertility(docs, texts, empty):
    import sentencepiece

    from tidelog.llm.fertility import SCRIPT_BANDS, accepted, script_of, score

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = []
    for doc, t, *_ in texts:
        t = t or ""
        words = WORDS.findall(t)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        ids = model.encode(t)
        n, counts = len(ids), Counter(ids)
        bits = -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0
        share = sum(model.is_byte(i) for i in ids) / n if n else 0.0
        per = len(t) / n if n else 0.0
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        kept = not failed and accepted(SCRIPT_BANDS[script_of(t)], n, per, share, bits)
        want.append((doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), n, round(per, 6), round(share, 6), round(bits, 6), failed, kept))
    got = [(*r[:7], *(round(x, 6) for x in r[7:10]), r.base_failed, r.kept) for r in score(docs, path).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert score(empty, path).count() == 0


def test_direct_codes(spark, docs, texts, empty, tmp_path):
    from tidelog.llm.direct_codes import read_documents, write_ids

    write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/ids", end_id=2, shard_ids=500)
    got = sorted(map(tuple, read_documents(spark, f"file://{tmp_path}/ids").collect()), key=lambda r: r[1])
    ids, at = _ids("byte_bpe_50k.json", 2), 0
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    for doc, start, n, _ in got:
        assert start == at
        at += n
    want = Counter((d, len(x := ids(t)), zlib.crc32(array("I", x).tobytes())) for d, t, *_ in texts)
    assert Counter((d, n, c) for d, _, n, c in got) == want
    write_ids(empty, public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/none", end_id=2)
    assert read_documents(spark, f"file://{tmp_path}/none").count() == 0


def test_shard_random_access():
    import numpy as np

    from tidelog.llm.direct_codes import Shard, encode_shard

    rng = np.random.default_rng(5)
    ids = (2 ** (rng.random(5000) * 31.9)).astype("u4")
    ids[:50] = rng.integers(0, 256, 50)
    for widths in ((8, 4, 4, 16), (6, 5, 5, 16), (16, 16), (3, 29)):
        shard = Shard(encode_shard(ids, np.array([0, 10, 10, 4000, 5000], "u8"), widths))
        assert [shard.access(int(i)) for i in range(0, 5000, 7)] == ids[::7].tolist()
        assert all((shard.document(d) == ids[a:b]).all() for d, (a, b) in enumerate([(0, 10), (10, 10), (10, 4000), (4000, 5000)]))
    with pytest.raises(ValueError):
        encode_shard(np.array([1 << 20], "u4"), np.array([0, 1], "u8"), (8, 8))
    assert Shard(encode_shard(np.empty(0, "u4"), np.array([0], "u8"))).n_ids == 0


def test_license_scan(spark, docs, texts, empty):
    from tidelog.llm.license_digest import KNOWN, known_digests, scan

    mit = KNOWN[0][1]
    odd = mit.replace("free of charge", "FREE OF CHARGE").replace(",", " ,").replace("sublicense", "sub license").replace("sublicense", "sub-licence")
    rows = [(1, mit), (2, "Copyright (c) 2020 A. Person\n(C) others\n\n" + odd), (3, mit + " more"), (4, "Released under the MIT Licence\nReleased under the mit license!\nx"), (5, None), (6, "..."), (None, mit), (1, mit)]
    known = known_digests(spark)
    got = {(r.doc_id, r.license_id, r.n_notices, tuple(r.notices)) for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    assert got == {(1, "MIT", 0, ()), (2, "MIT", 0, ()), (3, None, 0, ()), (4, None, 2, ("MIT",)), (5, None, 0, ()), (6, None, 0, ()), (None, "MIT", 0, ())}
    assert scan(docs, known).count() == len(texts)
    assert scan(docs, known.limit(0)).where("license_id is not null").count() == 0
    assert scan(empty, known).count() == 0


def test_mixing(spark, docs, empty):
    from tidelog.llm.mixing import leaf_budgets, mix

    leaves = spark.createDataFrame([("a", "x", 100), ("a", "y", 10), ("b", "z", 30), ("c", "q", 5)], "d string, l string, tokens long")
    weights = {"d": {"a": 2, "b": 2, "c": 0}, "l": {"y": 3}}
    given = {(r.d, r.l): r.given for r in leaf_budgets(leaves, ["d", "l"], 100, weights, 1).collect()}
    # b can give 30 of its 50: a takes the rest; in a, y is full at 10 and x takes its share.
    assert given == {("a", "x"): 60, ("a", "y"): 10, ("b", "z"): 30, ("c", "q"): 0}
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    total = docs.select(F.sum(F.ceil(F.octet_length("text") / 4))).first()[0]
    got = mix(docs, levels, budget=total // 2, weights={"lang": {"en": 3}}, slices=7)
    same = mix(docs, levels, budget=total // 2, weights={"lang": {"en": 3}}, slices=1)
    assert _collect(got) == _collect(same)
    assert got.agg(F.sum("take_tokens")).first()[0] == total // 2
    assert mix(docs, levels, budget=10 * total, weights={}, max_epochs=2).agg(F.sum("take_tokens")).first()[0] == 2 * total
    assert mix(empty, levels, budget_share=(1, 2), weights={}).count() == 0


@pytest.mark.parametrize("one_task", [0, 10_000])
def test_components(spark, one_task):
    import random

    from tidelog.llm.components import components

    rng = random.Random(one_task)
    edges = [(i, i + 1) for i in range(60)] + [(200, k) for k in range(201, 260)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(110)] + [(5, 5), (7, 6), (7, 6), (None, 3)]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in components(df, "t", one_task).collect()} == {x: root(x) for x in parent}
    assert components(df.limit(0), "t", one_task).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_many_texts_at_once_are_encoded_as_the_library_does(name, monkeypatch):
    """All kinds of neighbours, small slices and a cache that is cut again and again."""
    import random

    import pyarrow as pa

    from tidelog.llm import encoders

    rng = random.Random(3)
    parts = ["'", "'s", "'re", "'ll", "'S", "s", "t", "re", "ve", "a", "Bc", " ", "  ", "\n", "\t", "\r", "1", "23", "_", "-", "!", "é", "Ⱥ", "Ǆ", "…"]
    texts = [None, "", " ", "\n ", " \n", "'", "'s", "x" * 5000, "日本 a"] + ["".join(rng.choices(parts + ["\0", "\x1c", "\xa0", "²", "日"] * (i % 2), k=rng.randrange(14))) for i in range(4000)]
    monkeypatch.setattr(encoders, "TOGETHER", 3000)
    enc, ref = encoders.Encoder(public_tokenizers.path(name), cached=50), _ids(name, 7)
    assert [array("I", x).tolist() for x in enc.encode_all(pa.array(texts))] == [ref(t)[:-1] for t in texts]
    assert len(enc.often.values) <= 50
    assert list(enc.encode_all(pa.array([], pa.string()))) == []


def test_each_pre_token_is_looked_up_once(monkeypatch):
    """A slice costs one lookup for each distinct pre-token, not one for each that stands in it."""
    import pyarrow as pa

    from tidelog.llm.encoders import Encoder

    enc, asked = Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    of = enc.often.of
    monkeypatch.setattr(enc.often, "of", lambda keys, counts: asked.extend(keys) or of(keys, counts))
    list(enc.encode_all(pa.array(["one two one two " * 500] * 20)))
    assert len(asked) == len(set(asked)) < 10


def test_a_task_of_packing_leaves_no_cache_behind(monkeypatch):
    """The worker goes on to other stages: what it kept for a text is given back at the task's end."""
    import pyarrow as pa

    from tidelog.llm import packing
    from tidelog.llm.encoders import encoder

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(packing, "F", type("F", (), {"col": lambda c: type("C", (), {"cast": lambda s, t: s, "alias": lambda s, a: s})()}))
    path = public_tokenizers.path("word_bpe_49k.json")
    run = packing.cut_pieces(Docs(), path, end_id=1, capacity=64)
    done = list(run(iter([pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", "日本 words"])], ["doc_id", "text"])])))
    assert sum(b.num_rows for b in done) == 2
    enc = encoder(path, False, packing.CACHED)
    assert not enc.often.values and not enc.pieces and not enc.pieces.old

"""Source divergence, pairwise quality and lexical search against plain versions, and on odd tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import lexical_search, pairwise_quality, source_divergence, terms
from tidelog.llm.queries import op12_pairwise_quality

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ODD = ["", None, "É é É x", "a\0b", "one", "İstanbul ÀB9z", "x" * 70_000, "the the\tthe the 9", "\n\n", "日本 語 Ａ", "a1b2 C3", "end.", ".end"]


def _words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("digits,pattern", [(False, LETTERS), (True, WORDS)])
def test_cut_equals_regular_expression(digits, pattern):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("aZ9 .é\n\x7f@[`{日") for _ in range(rng.randrange(40))) for _ in range(500)]
    for column in (pa.array(texts), pa.chunked_array([texts]).chunk(0).slice(2), pa.array([], pa.string())):
        row, found = terms.cut(column, terms.alphabet(digits=digits))
        want = [(i, w) for i, t in enumerate(column.to_pylist()) for w in _words(t, pattern)]
        assert [(int(r), w.decode()) for r, w in zip(row, found.to_pylist())] == want
    parts = list(terms.parts(pa.array(texts), 1000))
    assert parts[0][0] == 0 and parts[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def _plain_audit(rows, min_docs, ranks):
    rows = [(t, lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs = [(source, _words(t, LETTERS)) for t, x, source in rows if x == lang]
        df = Counter(w for _, ws in docs for w in set(ws))
        kept = {w for w, n in df.items() if n >= min_docs}
        count = {s: Counter() for s, _ in docs}
        for s, ws in docs:
            count[s].update(w for w in ws if w in kept)
        whole = sum(count.values(), Counter())
        p = lambda c, w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023, E731
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pair = [(sum(f(p(count[s], w), p(count[o], w)) for w in kept), o) for o in count if o != s]
            term = [(f(p(count[s], w), p(whole, w)), w) for w in kept if count[s][w] and p(count[s], w) > p(whole, w)]
            for part, found, most in (("pair", pair, None), ("term", term, ranks)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def _rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_audit_equals_plain_version(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["the", "É", "é", "z", "日本", "Ａ", *[f"w{chr(97 + i)}" for i in range(12)]]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randrange(30))), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "ü", "", None])) for _ in range(150)]
    rows += [(None, "xx", "only"), ("", "xx", "other"), ("rare words", "yy", "alone")] + [(t, "odd", "o" + str(i % 2)) for i, t in enumerate(ODD)] * 2
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as n", "'x' as term", "2 as bucket")
    columns = ("lang", "source", "part", "item", "value", "rank")
    want = _plain_audit(rows, 5, 4)
    assert _rows(source_divergence.audit(df.repartition(5), min_docs=5, ranks=4), *columns) == want
    assert ("xx", "only", "pair", "other", 0, 1) in want
    monkeypatch.setattr(source_divergence, "BLOCK", 7)  # blocks of one or two terms
    numbers = {"a": 0, "b": 1}
    found = list(source_divergence._range("l", ["a", "b"], np.array([30, 12]), 5, np.array([b"x", b"y", b"x", b"z"], object), np.array([numbers[s] for s in "aaba"]), np.array([20, 10, 5, 7]), 10**9, 2, 1))
    monkeypatch.setattr(source_divergence, "BLOCK", 1 << 19)
    assert found == list(source_divergence._range("l", ["a", "b"], np.array([30, 12]), 5, np.array([b"x", b"y", b"x", b"z"], object), np.array([numbers[s] for s in "aaba"]), np.array([20, 10, 5, 7]), 10**9, 2, 1))
    assert source_divergence.audit(df.limit(0)).count() == 0


def test_shares_are_exact():
    counts = [0, 1, 7, 10**12, 123_456_789_012_345]
    for total, kept in ((0, 1), (10**13, 3), (4 * 10**15, 10**9)):
        want = [1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts if c <= total]
        assert source_divergence.shares(np.array([c for c in counts if c <= total]), total, kept, 10**9, 2).tolist() == want


def _plain_search(docs, items, top):
    cut = [(d, _words(t, WORDS)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in cut), sum(len(w) for _, w in cut)
    df = Counter(w for _, ws in cut for w in set(ws))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(_words(t, WORDS))
    out = []
    for i, ws in asked.items():
        found = []
        for d, have in cut:
            tf, m = Counter(have), 50 + (50 * len(have) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 20 * m)) for w in ws if tf[w])
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        out += [(i, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("query_bytes,block", [(8 << 20, 8192), (300, 7)])
def test_search_equals_plain_version(spark, monkeypatch, query_bytes, block):
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    rng = random.Random(2)
    vocabulary = ["the", "of", "9", "é", *[f"w{i}" for i in range(40)]]
    docs = [(i // 2 if i % 5 == 0 else i, " ".join(rng.choices(vocabulary, k=rng.randrange(25)))) for i in range(200)] + [(None, "w1 w2"), (None, "w1 w2"), (-7, "W1")]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(i, "w3 w3 the") for i in range(300, 330)]  # ties
    items = [(i, " ".join(rng.choices(vocabulary, k=6))) for i in range(12)] + [(12, None), (13, ""), (14, "nowhere"), (None, "w5"), (3, "w39"), (15, "w3 w3")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as item_id", "3 as terms")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "'x' as part")
    got = lexical_search.search(d.repartition(4), q, top=10).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == _plain_search(docs, items, 10)


def test_search_of_empty_tables(spark):
    d, q = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(d.limit(0), q).count() == 0
    assert lexical_search.search(d, q.limit(0)).count() == 0
    assert [tuple(r) for r in lexical_search.search(d, q).collect()] == [(1, 1, 1, 287 * (10**9 // 3000))]


def test_norms_of_huge_corpora():
    lengths = np.array([1, 10**7])
    assert lexical_search.norms(lengths, 10**11, 10**14).tolist() == [50 + 50 * n * 10**11 // 10**14 for n in lengths.tolist()]


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op12_pairwise_quality(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for d, r in got.items())
    out = [(q, got[d]) for d, q in labels if d in got and got[d].held_out]
    good, bad = [r.score for q, r in out if q], [r.score for q, r in out if not q]
    assert len(bad) >= 10 and np.mean([r.predicted == q for q, r in out]) >= 0.97
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.99  # pairs in the right order


def test_held_out_labels_are_not_learnt(spark):
    ids = [i for i in range(400)]
    docs = spark.createDataFrame([(i, "plain words in a row " * 3 if i % 2 else "!!! ### $$$ " * 5, "en") for i in ids], "doc_id long, text string, lang string")
    labels = lambda flip: spark.createDataFrame([(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 3 == 1)) for i in ids], "doc_id long, quality int")
    one, two = (pairwise_quality.train(docs, labels(flip)) for flip in (False, True))
    assert np.array_equal(one.weights, two.weights) and one.threshold == two.threshold
    # No document's own id, language or source changes its score.
    moved = docs.selectExpr("doc_id + 1000 as doc_id", "text", "'fr' as lang", "'s' as source")
    a, b = (pairwise_quality.score(x, one).collect() for x in (docs, moved))
    assert sorted(r.score for r in a) == sorted(r.score for r in b)
    assert {(r.doc_id % 2, r.predicted) for r in a} == {(0, 0), (1, 1)}


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x", 2), (1, "same id", 3), (1, "same id", 3)], "doc_id long, text string, score int")
    none = pairwise_quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = pairwise_quality.score(docs, none, keep=["score"]).collect()
    assert len(rows) == len(ODD) + 3 and {(r.score, r.predicted) for r in rows} == {(0.5, 1)} and {r.kept_score for r in rows} == {1, 2, 3}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    one_kind = pairwise_quality.train(docs, spark.createDataFrame([(0, 1), (2, 1), (3, None), (None, 0)], "doc_id long, quality int"))
    assert not one_kind.weights.any()
    both = pairwise_quality.train(docs, spark.createDataFrame([(i, q) for i in range(12) for q in (0, 1)], "doc_id long, quality int"))
    assert not both.weights.any()  # an id with both labels prefers nothing
    assert pairwise_quality.score(docs.limit(0), none).count() == 0


def test_preferences_are_learnt_in_closed_form():
    """With one feature and one pair the weight solves its own optimum."""
    x, good = np.array([[1.0], [0.0]]), np.array([True, False])
    r = pairwise_quality.learn(x, good, bad_share=0.5, pairs=10, penalty=0.01)
    d = (x[0] - x[1]) / r.scale
    assert math.isclose(float(d[0] / (1 + math.exp(r.weights[0] * d[0]))), 0.01 * r.weights[0], rel_tol=1e-6)
    assert r.score(x)[0] > 0.5 > r.score(x)[1]


def test_a_template_under_the_threshold_compares_nothing(spark):
    """2000 texts of two templates: of the one under 80 per cent no two are compared, of the other all."""
    from tidelog.llm.hyperminhash import _able_pairs, _meetings, _partner_sizes, near_duplicates

    texts = [(i, f"thank you for all of your orders n{i}") for i in range(1900)]  # 7 shingles, 6 shared: 75 per cent
    texts += [(i, f"we will be in touch with you again soon n{i}") for i in range(1900, 2000)]  # 9 shingles, 8 shared: 80 per cent
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    members = spark.createDataFrame([(i, len(t.split()) - 1, i) for i, t in texts], "class_id long, n int, component long")
    pairs = _able_pairs(docs, members, 2, 80).collect()
    assert len(pairs) == 100 * 99 // 2 and min(r.b for r in pairs) == 1900
    rows = [("hot", i, 8, i, 2, 6, 0) for i in range(2000)]
    early = spark.createDataFrame(rows, "shingle string, class_id long, n int, component long, at int, left int, most long")
    assert _partner_sizes(early, 80).count() == 0 and _meetings(early, 80).count() == 0
    mixed = spark.createDataFrame([*rows[:50], ("hot", 9001, 8, 9001, 1, 7, 0), ("hot", 9002, 8, 9002, 1, 7, 0), ("hot", 9003, 7, 9001, 1, 6, 0), ("hot", 9004, 30, 9004, 1, 29, 0)], early.schema)
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in _meetings(mixed, 80).collect()}
    want = {(a.class_id, b.class_id) for a in mixed.collect() for b in mixed.collect() if a.class_id < b.class_id and a.component != b.component and (1 + min(a.left, b.left)) * 180 >= 80 * (a.n + b.n) and min(a.n, b.n) * 100 >= max(a.n, b.n) * 80}
    assert got == want and (9001, 9002) in got
    assert {r.component_id == r.doc_id for r in near_duplicates(docs.where('doc_id < 200'), shingle_words=2, percent=80).collect()} == {True}


def test_rows_without_an_id_are_drawn_without_regard_to_length(spark):
    """A quarter of 2000 texts of 1 to 50 tokens that share a null id, then one id: the prefix has all lengths, however the rows lie."""
    from pyspark.sql import functions as F

    from tidelog.llm.mixing import mix

    rng = random.Random(9)
    texts = [f"{i:06d}"[:4] * rng.randrange(1, 51) + f"{i}" for i in range(2000)]
    for doc_id in (None, 5):
        docs = spark.createDataFrame([(doc_id, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n int")
        run = lambda df: {(r.n, r.take_tokens) for r in mix(df, {"a": F.lit("x")}, budget_share=(1, 4), weights={}, max_epochs=1, seed=3, keep=["n"]).collect()}  # noqa: B023, E731
        got = run(docs.repartition(7))
        assert run(docs.orderBy(F.col("n").desc()).repartition(3)) == got
        lengths = [-(-len(texts[n].encode()) // 4) for n, _ in got]
        every = [-(-len(t.encode()) // 4) for t in texts]
        assert sum(t for _, t in got) == sum(every) // 4 and abs(np.mean(lengths) - np.mean(every)) < 2.5 and max(lengths) > 45 and min(lengths) < 6


def test_bands_reject_junk_and_have_no_step(spark):
    """Bands fitted to clean texts and applied, with figures counted here by the library alone."""
    import public_tokenizers
    import sentencepiece

    from tidelog.llm.fertility import ABOVE_COUNTS, SCRIPT_BANDS, blended, clean_bands, fitted, score

    rng = random.Random(1)
    vocabulary = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who".split()
    clean = [" ".join(rng.choices(vocabulary, k=rng.randrange(60, 200))) + "." for _ in range(120)]
    junk = [" ".join("".join(rng.choices("qxzjkvw", k=9)) for _ in range(80)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean + junk)] + [(0, "zz " * 70, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(120)], "doc_id long, quality int")
    path = public_tokenizers.path("piece_bpe_32k.model")
    bands = clean_bands(docs, labels, path)
    assert clean_bands(docs.repartition(5), labels, path) == bands  # of an id with two texts always the same one counts
    kept = {r.doc_id: r.kept for r in score(docs.where("text NOT LIKE 'zz%'"), path, language_bands=bands).collect()}
    assert sum(kept[i] for i in range(120)) >= 118 and not any(kept[i] for i in range(120, 140))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    per = lambda t: len(t) / len(model.encode(t))
    assert max(map(per, junk)) < min(map(per, clean))
    low = bands["en", "latin"].chars_per_token[0]
    assert max(map(per, junk)) < low < np.quantile(list(map(per, clean)), 0.05)
    figures = [(100 + i, 3.0 + i % 7 / 10, 0.0, 5.0 + i % 5 / 10) for i in range(200)]
    bounds = [blended(fitted(figures[:n]), SCRIPT_BANDS["latin"], n).chars_per_token[0] for n in range(2, 200)]
    assert max(abs(a - b) for a, b in zip(bounds, bounds[1:])) < 0.12 and bounds[0] < bounds[-1] <= 3.0 and ABOVE_COUNTS > 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_strings_are_text_or_tokens(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidelog.llm.encoders import encoder

    path, rng = public_tokenizers.path(name), random.Random(0)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", " ", "Hello", "wörld", "\n", "日本", "a<|endoftext|>b"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(8))) for _ in range(300)]
    for special in (False, True):
        plain = Tokenizer.from_file(path)
        plain.encode_special_tokens = not special
        for text in texts:
            assert np.frombuffer(encoder(path, special).encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_bands_are_fitted_to_every_clean_text(spark):
    """More clean ids than 4096, those that are last by hash unlike the others; the fit by Spark equals the fit of the list."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from tidelog.llm.fertility import SCRIPT_BANDS, blended, clean_bands, fitted, measure

    rng, n = random.Random(2), 4300
    last = {r.id for r in spark.range(n).orderBy(F.xxhash64("id").desc()).limit(100).collect()}
    common = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all".split()
    rare = "zephyr quixotic labyrinth mnemonic syzygy ptarmigan fjord rhythm xylophone kaleidoscope".split()
    rows = [(i, " ".join(rng.choices(common + (rare if i in last else []), k=rng.randrange(*((50, 60) if i in last else (70, 160))))), rng.choice(["en", "de", None])) for i in range(n)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    path = public_tokenizers.path("piece_bpe_32k.model")
    bands = clean_bands(docs, labels, path)
    figures = [(r.lang, (r.n_tokens, r.chars_per_token, r.byte_share, r.token_entropy)) for r in measure(docs, path).collect() if not r.base_failed]
    assert len(figures) > 4250
    above = blended(fitted([f for _, f in figures]), SCRIPT_BANDS["latin"], len(figures))
    want = {(None, "latin"): above}
    for lang in ("en", "de"):
        own = [f for x, f in figures if x == lang]
        want[lang, "latin"] = blended(fitted(own), above, len(own))
    assert bands.keys() == want.keys()
    for k, band in want.items():
        flat = lambda b: [*b.chars_per_token, b.byte_share, *b.entropy, b.min_tokens, *[v for p in b.floor for v in p]]
        assert flat(bands[k]) == pytest.approx(flat(band), abs=3e-4)

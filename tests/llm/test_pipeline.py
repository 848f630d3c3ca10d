"""The pipeline stage by stage against brute force, on a small table."""

import hashlib
import zlib
from array import array
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm.test_documents import _components, _ids

WEIGHTS = corpus_pipeline.MIX_WEIGHTS


def _fill(children, given):
    """Shares of siblings (name, weight, capacity), rounded as their cumulative shares are."""
    out, rest, open_ = {}, given, sorted(children, key=lambda c: (c[2] / c[1], c[0]))
    weight = sum(c[1] for c in open_)
    full = []
    for c in open_:
        if c[2] * weight <= c[1] * rest:
            full.append(c)
            rest, weight = rest - c[2], weight - c[1]
        else:
            break
    for c in full:
        out[c[0]] = c[2]
    before = 0
    for c in open_[len(full) :]:
        share = rest * (before + c[1]) // weight - rest * before // weight
        out[c[0]] = min(c[2], share)
        before += c[1]
    return out


def _mixed(docs):
    rows = []
    for r in docs:
        tokens = -(-len((r.text or "").encode()) // 4)
        number = int("".join(c for c in r.source if c.isdigit()) or 0)
        if tokens:
            rows.append((r.doc_id, f"domain{number % 3}", r.lang, r.source, tokens, hashlib.md5(r.text.encode()).hexdigest()))
    total = sum(r[4] for r in rows)
    by = lambda *k: {key: sum(r[4] for r in rows if tuple(r[i] for i in k) == key) for key in {tuple(r[i] for i in k) for r in rows}}
    one = _fill([(d, WEIGHTS["domain"].get(d, 1), c) for (d,), c in by(1).items()], total * 9 // 10)
    kept = set()
    for d, g in one.items():
        two = _fill([(x, WEIGHTS["lang"].get(x, 1), c) for (e, x), c in by(1, 2).items() if e == d], g)
        for lang, g2 in two.items():
            three = _fill([(s, WEIGHTS["source"].get(s, 1), c) for (e, x, s), c in by(1, 2, 3).items() if (e, x) == (d, lang)], g2)
            for source, g3 in three.items():
                mine = [r for r in rows if r[1:4] == (d, lang, source)]
                whole, part = divmod(g3, sum(r[4] for r in mine))
                if whole:
                    kept |= {r[0] for r in mine}
                    continue
                at = 0
                for r in sorted(mine, key=lambda r: hashlib.md5(f"17:{whole}:{r[0]}:{r[5]}".encode()).hexdigest()):
                    if at < part:
                        kept.add(r[0])
                    at += r[4]
    return kept


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    base = spark.conf.get("spark.checkpoint.dir")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{base}/test-pipeline-{i}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        out.append((name, docs.collect(), spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_columns(stages, spark, sf_dir):
    want = spark.read.parquet(f"{sf_dir}/documents.parquet").dtypes
    assert all(df.dtypes == want for _, _, df in stages[:-1])


def test_quality_rules(stages, spark, sf_dir):
    """What fails the base rules goes; of the rest all labelled junk and nothing labelled clean."""
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    by_label = Counter()
    for r in before:
        words = (r.text or "").split()
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        passed = len(words) >= 50 and 100 * len(covered) <= 50 * len(words)
        assert passed or r.doc_id not in kept
        if passed:
            by_label[quality.get(r.doc_id), r.doc_id in kept] += 1
    assert by_label[0, False] >= 5 and by_label[1, True] >= 50 and by_label[0, True] == by_label[1, False] == 0
    assert by_label[None, False] <= 0.2 * by_label[None, True]
    assert after.count() == len(kept)


def test_near_duplicates(stages):
    _, before, after = stages[1]
    want = {d for d, _, _, kept in _components([(r.doc_id, r.text) for r in before], 5) if kept}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)
    texts = {r.doc_id: r for r in before}
    assert all(texts[r.doc_id] == r for r in after.collect())


def test_source_mix(stages):
    _, before, after = stages[2]
    rows = after.collect()
    assert sorted(r.doc_id for r in rows) == sorted(_mixed(before))
    texts = {r.doc_id: r for r in before}
    assert all(texts[r.doc_id] == r for r in rows)


def test_packing(stages):
    _, before, after = stages[3]
    ids, want = _ids("word_bpe_49k.json", 1), Counter()
    for r in before:
        all_ids = ids(r.text)
        for at in range(0, len(all_ids), 2048):
            piece = all_ids[at : at + 2048]
            want[r.doc_id, at, len(piece), zlib.crc32(array("I", piece).tobytes()), len(all_ids)] += 1
    rows = after.collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    used: dict = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 2048


def test_odd_tables(spark, sf_dir):
    """Nulls, repeated rows, extra columns and empty tables go through every stage."""
    rows = [(None, "w " * 60, "en", "s", 1), (1, None, None, None, None), (2, " ".join(f"a{i}" for i in range(80)), None, None, None)]
    rows += [rows[-1]] * 2 + [(3, " ".join(f"b{i}" for i in range(80)), "", "src1", 5), (None, " ".join(f"c{i}" for i in range(90)), "de", "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS start", "2 AS bucket")
    for df in (docs, docs.limit(0)):
        quality = corpus_pipeline.quality_rules(spark, df, sf_dir)
        assert {r.doc_id for r in quality.collect()} == ({2, 3, None} if df is docs else set())
        kept = corpus_pipeline.minhash_near_dedup(spark, quality, sf_dir)
        assert {(r.doc_id, r.lang, r.source) for r in kept.collect()} == ({(2, None, None), (3, "", "src1"), (None, "de", "")} if df is docs else set())
        mixed = corpus_pipeline.source_mix(spark, kept, sf_dir)
        assert mixed.columns == corpus_pipeline.COLUMNS
        assert set(mixed.collect()) <= set(kept.collect())  # empty and null values stay as they were
        assert corpus_pipeline.packing(spark, mixed, sf_dir).count() == mixed.count()


def test_quality_stage_hears_every_clean_label(spark, tmp_path):
    """More clean ids than 4096: texts unlike the others are kept if only labels that are last by hash speak for them."""
    import random

    from pyspark.sql import functions as F

    rng, n = random.Random(3), 4300
    last = {r.id for r in spark.range(n).orderBy(F.xxhash64("id").desc()).limit(100).collect()}
    words = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all".split()
    text = lambda i: " ".join("".join(rng.choices("qxzjkvw", k=9)) for _ in range(80)) if i in last else " ".join(rng.choices(words, k=rng.randrange(60, 150)))
    spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in ((i, text(i)) for i in range(n))], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert len(kept & last) >= 90

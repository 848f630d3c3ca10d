"""Findings of the first review: each test fails on the code as it was."""

import random

import public_tokenizers


def test_junk_is_rejected_and_clean_text_kept(spark):
    from tidelog.llm.queries import op8_fertility

    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    passed = [r for r in op8_fertility(spark, sf_dir).collect() if not r.base_failed and r.doc_id in labels]
    clean, junk = ([r.kept for r in passed if labels[r.doc_id] == q] for q in (1, 0))
    assert len(junk) == 27 and sum(junk) <= 2
    assert sum(clean) >= 0.98 * len(clean)


def test_random_ideographs_are_rejected(spark):
    from tidelog.llm.fertility import score

    rng = random.Random(4)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(4)) for _ in range(80))
    prose = "人人 生而 自由 在 尊严 和 权利 上 一律 平等 他们 赋有 理性 和 良心 并 应以 兄弟 关系 的 精神 相 对待 人人 有 资格 享有 本 宣言 所 载 的 一切 权利 不分 种族 肤色 性别 语言 宗教 政治 或 其他 见解 国籍 财产 出生 身份 任何 人 不得 使 为 奴隶 均 受 法律 保护"
    rows = spark.createDataFrame([(1, noise, "zh"), (2, prose, "zh")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in score(rows, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {1: (False, False), 2: (False, True)}


def test_short_near_duplicates_are_all_found(spark):
    from tests.llm.test_documents import _components
    from tidelog.llm.hyperminhash import near_duplicates

    rows = []
    for k in range(400):  # 9 shared of a union of 10
        words = [f"p{k}x{i}" for i in range(9)]
        rows += [(2 * k, " ".join([*words, "first"]), "", ""), (2 * k + 1, " ".join(words), "", "")]
        if k % 2:  # 8 shared of a union of 10
            rows[-2:] = [(2 * k, " ".join([*words[:8], f"q{k}"]), "", ""), (2 * k + 1, " ".join([*words[:8], f"r{k}"]), "", "")]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(df, shingle_words=1).collect()), key=repr)
    assert got == _components(rows, 1)
    assert sum(r[3] for r in got) == 400


def test_whole_licences_and_every_known_line(spark):
    from tidelog.llm.license_digest import KNOWN, known_digests, scan

    text = lambda name: open(f"/usr/share/common-licenses/{name}").read()
    rows = [(1, text("Apache-2.0")), (2, "Copyright (c) me\n\n" + text("BSD")), (3, text("GPL-3").upper()), (4, text("MPL-2.0")), (5, text("LGPL-2.1"))]
    rows += [(6, "x\n  - Available under CC-BY-SA 4.0 -\ny"), (7, "x\nReleased under" + " " * 500 + "the MIT License\ny")]
    known = known_digests(spark, (*KNOWN, ("CC-BY-SA-4.0", "Available under CC-BY-SA 4.0")))
    got = {r.doc_id: (r.license_id, r.notices) for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    assert [got[i][0] for i in range(1, 8)] == ["Apache-2.0", "BSD-3-Clause", "GPL-3.0", "MPL-2.0", "LGPL-2.1", None, None]
    assert (got[6][1], got[7][1]) == (["CC-BY-SA-4.0"], ["MIT"])


def test_pipeline_keeps_clean_rows_without_an_id(spark):
    import corpus_pipeline

    prose = [" ".join(f"{k}{i}" for i in range(80)) for k in "abcd"]
    rows = [(None, prose[0]), (None, prose[0]), (None, prose[0] + " more"), (None, prose[1]), (7, prose[1]), (8, prose[2]), (8, prose[3]), (8, prose[3]), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.minhash_near_dedup(spark, docs, "").collect()), key=repr)
    assert [x for x in got if x[0] is not None] == [(7, prose[1]), (8, prose[2])]
    texts = [t for i, t in got if i is None]
    assert len(texts) == 2 and None in texts and (prose[0] in texts or prose[0] + " more" in texts)


def test_all_shared_keys_of_a_recording_are_probed(spark):
    from tidelog.llm.audio_chroma import align

    rng = random.Random(6)
    codes = [rng.randrange(1 << 32) for _ in range(100)]
    noisy = [c ^ (1 << (12 + i % 20)) if i % 5 else c for i, c in enumerate(codes)]  # 80 keys of its own
    rows = [(100, "a", noisy), (1, "b", codes), (2, "c", codes[10:]), (3, "d", [rng.randrange(1 << 32) for _ in range(100)])]
    got = {r.rec_id: (r.n_links, r.best_query, r.best_offset) for r in align(spark.createDataFrame(rows, "rec_id long, digest string, codes array<long>")).collect()}
    assert got == {100: (0, None, None), 1: (1, 100, 0), 2: (1, 100, 10), 3: (0, None, None)}


def test_weight_of_zero_at_an_inner_level(spark):
    from tidelog.llm.mixing import leaf_budgets

    leaves = spark.createDataFrame([("a", "x", "p", 100), ("a", "y", "q", 10), ("b", "z", "r", 200), ("c", "u", "s", 50), ("c", "u", "t", 5)], "d string, l string, s string, tokens long")
    got = {r.s: r.given for r in leaf_budgets(leaves, ["d", "l", "s"], 150, {"l": {"x": 0}, "s": {"s": 0}}, 1).collect()}
    assert got == {"p": 0, "q": 10, "r": 135, "s": 0, "t": 5}

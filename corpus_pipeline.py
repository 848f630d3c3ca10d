"""A corpus pipeline: quality rules, near duplicates, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import discard, remove, scratch
from tidelog.llm.fertility import score_by_labels
from tidelog.llm.hyperminhash import near_duplicates
from tidelog.llm.mixing import mix
from tidelog.llm.packing import pack_documents
from tidelog.llm.queries import MIX_WEIGHTS, mix_levels, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Keys from here to twice this stand for texts without an id; ids lie below.
NAMELESS = 1 << 61


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands of all clean ones in ``labels``."""
    scored = score_by_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), vocabulary("piece_bpe_32k.model"), keep=COLUMNS, base_passed=True)
    out = scored.where("kept").select([F.col(f"kept_{c}").alias(c) for c in COLUMNS])
    out._tidelog_path = scored._tidelog_path
    return out


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 80 per cent): that with the least id.

    Rows that share an id are one document, linked with all that any of their texts is
    linked with; if their texts differ, the first row in order of the columns is kept. Rows
    without an id are documents by their text (or the lack of one): of a group in which none
    has an id the row of one text is kept, and a row with an id goes before those without.
    """
    nameless = F.lit(NAMELESS) + F.pmod(F.xxhash64("text"), F.lit(NAMELESS))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), nameless).alias("row_key"), *COLUMNS)
    kept = near_duplicates(keyed, shingle_words=5, percent=80, id_col="row_key").where("kept").select(F.col("doc_id").alias("row_key")).distinct()
    row = F.min(F.struct(*COLUMNS)).alias("row")
    return keyed.join(kept, "row_key", "left_semi").groupBy("row_key").agg(row).select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix: nine tenths of the tokens, each document at most once, the last of a source whole."""
    chosen = mix(docs, mix_levels(), budget_share=(9, 10), weights=MIX_WEIGHTS, max_epochs=1, seed=17, keep=COLUMNS)
    back = docs.select(COLUMNS).schema  # columns that are named as levels or ids come back under other names
    return chosen.select([F.col(f"kept_{c}" if f"kept_{c}" in chosen.columns else c).cast(back[c].dataType).alias(c) for c in COLUMNS])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Tokenisers, signatures and first-fit packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; of what the stages wrote only the last is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        staged = stage(spark, docs, sf_dir)
        staged.write.parquet(path)
        discard(staged)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs

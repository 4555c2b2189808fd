"""Corpus pipeline: the stages of a training-data run over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet in the session's shared folder and read back as the next one's
documents. All but the last return the columns of documents.

1. Quality classifier: documents outside the Gumbel top-k go; k follows from
   the calibrated threshold, so clean documents stay.
2. SimHash near-dedup: of each group one row stays (3-word shingles, at most 2
   differing bits), that of the smallest id; null ids come last, rows of one id
   are told apart by a hash of their text. Rows are grouped one by one: a
   repeated id neither keeps a copy nor takes another text with it.
3. Benchmark decontamination: documents with a hit go.
4. Secret scan: each secret is replaced by a mask.
5. BPE: token ids of what is left, and their count."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.llm import bpe, decontaminate, quality, secret_scan, simhash
from indtables.llm.common import cut, table

SHINGLE, MAX_BITS = 3, 2
# Stretches that a worker remembers; its memory is shared by all stages here.
REMEMBERED = 100_000
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    groups = simhash.near_duplicates(rows, shingle=SHINGLE, max_bits=MAX_BITS, id_col=row).select(row, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("h"), F.col(row).alias("row"))
    first = rows.select(row, order.alias("first")).join(groups, row).groupBy("component_id").agg(F.min("first").alias("first"))
    kept = first.select(F.col("first.row").alias(row))
    copies = cut(rows.select(row).join(kept, row, "left_anti"), "pipeline-copies")  # fewer than the rows that stay
    return rows.join(copies, row, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(secret_scan.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = bpe.encode(docs, VOCABULARY, remembered=REMEMBERED)
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", keep_one),
    ("benchmark decontamination", drop_leaks),
    ("secret scan", mask_secrets),
    ("bpe encoding", encode),
]

# No stage's decisions can be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs

"""Scan every bronze document under one source folder.

Bronze is append-only history: all pulls are read, and the scan adds each
document's lineage (file modification time and name) so the silver dedupe
can prefer the newest pull. Malformed JSON fails the read (FAILFAST) rather
than turning into an all-NULL row that the unnest would silently drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indtables.operators.silver import PULL_FILE, PULL_STAMP, PULLED_AT
from indtables.sources.packing import packs, parsed, read_packs

# A UTC stamp in an object's name, as in 20260601T120000Z.
NAME_STAMP = r"(\d{8}T\d{6})"


def bronze_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}"


def with_lineage(docs: DataFrame) -> DataFrame:
    """Adds where each document came from: the pull's stamp (from the document,
    else from the file's name, else NULL), file time and file name."""
    name = F.col("_metadata.file_name")
    return docs.select("*", *_lineage(docs, name, F.col("_metadata.file_modification_time")))


def _lineage(docs: DataFrame, name: Column, time: Column) -> list[Column]:
    stamp = F.nullif(F.regexp_extract(name, NAME_STAMP, 1), F.lit(""))
    if "pulled_at" in docs.columns:
        stamp = F.coalesce("pulled_at", stamp)
    return [stamp.alias(PULL_STAMP), time.alias(PULLED_AT), name.alias(PULL_FILE)]


def read_bronze(
    spark: SparkSession, root: str, source: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Documents of ``source`` under ``root`` with an explicit schema.

    ``multi_line=False`` reads JSON lines (what ``write_bronze`` lands; files
    split across tasks). ``multi_line=True`` reads files that each hold one
    pretty-printed document, one task per file. Documents that were packed
    (``sources.packing``) are read from their packs, once."""
    df = (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .json(bronze_path(root, source))
    )
    df = with_lineage(df)
    folders = packs(spark, root, source)
    if not folders:
        return df
    packed = read_packs(spark, folders)
    docs = parsed(packed, schema)
    docs = docs.select(*schema.names, *_lineage(docs, F.col("_name"), F.col("_time")))
    ledger = packed.select(F.col("pull_file").alias(PULL_FILE)).distinct()
    return df.join(ledger, PULL_FILE, "left_anti").select(*docs.columns).unionByName(docs)

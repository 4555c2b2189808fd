"""Incremental intake of bronze pulls.

Bronze is append-only, so instead of re-parsing every document on each run,
a file stream picks up only the pulls landed since the last run
(``trigger(availableNow=True)``: process what is there, then stop) and
appends their conformed candidates (good rows and rejects with a reason,
the same table the batch refresh writes) to a landing table.

The stream's checkpoint is the caller's to place: next to the landing table it
belongs to, because a checkpoint and a landing table that do not match lose or
repeat pulls. The age of a file decides nothing: Spark's file source ignores
files much older than the newest one it has seen, so that limit is set beyond
any history, and a restored or backfilled pull is taken like any other.

The parse is the batch parse: every step is a stateless column expression,
valid on a streaming DataFrame. ``silver_from_landing`` dedupes the whole
landing table; the incremental refresh instead merges only the newly landed
rows into the previous silver (``plans.refresh``). Both equal the batch
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.operators import silver as dedupe
from indtables.operators.conform import accepted, parse_feed_a, parse_feed_b, rejected, union_feeds
from indtables.operators.silver import PULL_FILE, PULL_STAMP, PULLED_AT, dedupe_observations
from indtables.schemas import FEED_A_SCHEMA, FEED_B_SCHEMA
from indtables.sources.bronze import with_lineage

LINEAGE = [PULL_STAMP, PULLED_AT, PULL_FILE]
INGEST_ID = "_ingest_id"
# Longer than any history: see the module doc.
ANY_AGE = "100000d"
# The folders of the two feeds.
FOLDERS = {"a": "banxico", "b": "inegi"}


def _ensure_dir(spark: SparkSession, path: str, schema) -> None:
    """A file stream needs its folder to exist. When it is missing, writing
    an empty frame creates it (no documents) on any filesystem."""
    try:
        spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if (e.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([], schema).write.mode("append").json(path)


def conform_new_pulls(
    spark: SparkSession,
    bronze_root: str,
    landing_path: str,
    checkpoint: str,
    feeds: Sequence[str] = ("a", "b"),
    labels: dict[str, str] | None = None,
    max_files_per_batch: int | None = None,
    ingest_id: int | None = None,
) -> None:
    """Parse the not-yet-seen documents of the feeds and append their
    candidates to ``landing_path``, in one stream: one sink, one checkpoint,
    so the landing table is committed atomically per micro-batch.
    ``max_files_per_batch`` bounds each micro-batch, so a large backlog is
    taken in several committed steps (``availableNow`` still drains it all).
    ``ingest_id`` tags every row landed by this call, so a later step can pick
    out what is new."""
    parts = []
    for feed in feeds:
        schema = FEED_A_SCHEMA if feed == "a" else FEED_B_SCHEMA
        path = f"{bronze_root.rstrip('/')}/{FOLDERS[feed]}"
        _ensure_dir(spark, path, schema)
        reader = spark.readStream.schema(schema).option("mode", "FAILFAST").option("maxFileAge", ANY_AGE)
        if max_files_per_batch:
            reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
        docs = with_lineage(reader.json(path))
        if feed == "a":
            parts.append(parse_feed_a(docs, labels=labels, carry=LINEAGE))
        else:
            parts.append(parse_feed_b(docs, carry=LINEAGE))
    cand = union_feeds(*parts)
    if ingest_id is not None:
        cand = cand.withColumn(INGEST_ID, F.lit(ingest_id).cast("long"))
    (
        cand.writeStream.format("parquet")
        .option("path", landing_path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", dedupe.ROWS_A_FILE)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def landed_rows(spark: SparkSession, landing_path: str) -> DataFrame:
    """Good rows landed so far (conformed observations with lineage)."""
    return accepted(spark.read.parquet(landing_path), carry=LINEAGE)


def landed_rejects(spark: SparkSession, landing_path: str) -> DataFrame:
    """Rejected rows landed so far, with their reason and pull."""
    return rejected(spark.read.parquet(landing_path), carry=LINEAGE)


def silver_from_landing(spark: SparkSession, landing_path: str) -> DataFrame:
    """Silver over everything landed so far (batch dedupe)."""
    return dedupe_observations(landed_rows(spark, landing_path))

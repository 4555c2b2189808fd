"""L1-L4: bronze -> silver -> gold long + gold wide, one callable.

``run(spark, bronze_root, out_root)`` can be called from any scheduler.

1. every bronze document is parsed once into *conformed candidates* (good
   rows and rejects with their reason), written as a table;
2. silver (deduped good rows) and the rejects table are read from it with
   the reason filter pushed into the scan;
3. both gold tables are built from the written silver;
4. the finished tables are published together (``sinks.publish``): readers
   (``published``) have the refresh before this one until then.

Each step reads a written table, so a lost executor recomputes from
Parquet, never from the raw JSON, and the JSON parse runs exactly once.
Every table is replaced, never appended, so a rerun gives the same rows. Rows
are counted while they are written, no table is read again for its count.
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.operators import silver as dedupe
from indtables.operators.conform import accepted, parse_feed_a, parse_feed_b, rejected, union_feeds
from indtables.operators.long import gold_long
from indtables.operators.silver import PULL_FILE, PULL_STAMP, PULLED_AT, dedupe_observations, enforce_not_null
from indtables.operators.wide import RECENT_WINDOW_DAYS, gold_wide
from indtables.plans import incremental
from indtables.schemas import FEED_A_SCHEMA, FEED_B_SCHEMA
from indtables.session import path_exists, scan_splits
from indtables.sinks.publish import Release, current, expire, new_release, publish, read_release
from indtables.sinks.writers import write_counted, write_parquet
from indtables.sources.bronze import read_bronze
from indtables.sources.gold import missing_table, read_gold
from indtables.sources.packing import packs

FEED_A_FOLDER = "banxico"
FEED_B_FOLDER = "inegi"
LINEAGE = [PULL_STAMP, PULLED_AT, PULL_FILE]
SERIES_ORDER = ["source", "indicator_id", "obs_date"]


@dataclass(frozen=True)
class Tables:
    """The tables of one release, as lazy DataFrames. Resolved once, they stay
    those of that release while later refreshes publish theirs."""

    spark: SparkSession
    release: Release

    @property
    def incremental(self) -> bool:
        return self.release.info["mode"] == "incremental"

    @property
    def counts(self) -> dict[str, int]:
        return dict(self.release.info["counts"])

    def silver(self) -> DataFrame:
        if self.incremental:
            return incremental.read_silver(self.spark, self.release)
        return read_release(self.spark, self.release, "silver")

    def long(self) -> DataFrame:
        if self.incremental:
            return incremental.read_long(self.spark, self.release)
        return read_release(self.spark, self.release, "indicators_long")

    def wide(self) -> DataFrame:
        return read_release(self.spark, self.release, "indicators_wide")

    def conformed(self) -> DataFrame:
        """Every good row and reject, with its pull, that the release is built from."""
        if not self.incremental:
            return read_release(self.spark, self.release, "conformed")
        from indtables.streaming.bronze_stream import INGEST_ID

        landed = _landed(self.spark, Intake(self.release.root))
        return landed.filter(F.col(INGEST_ID) <= self.release.info["merged_through"])

    def rejects(self) -> DataFrame:
        if self.incremental:  # not kept twice: the reason filter reaches the landed table's scan
            return rejected(self.conformed(), carry=LINEAGE)
        return read_release(self.spark, self.release, "rejects")


def published(spark: SparkSession, out_root: str) -> Tables:
    """The tables of the last refresh of ``out_root``."""
    release = current(spark, out_root)
    if release is None:
        raise missing_table(out_root)
    return Tables(spark, release)


@dataclass(frozen=True)
class Intake:
    """Where an incremental refresh lands what it has parsed."""

    root: str

    @property
    def conformed(self) -> str:
        return f"{self.root.rstrip('/')}/intake/conformed"

    @property
    def checkpoint(self) -> str:
        return f"{self.root.rstrip('/')}/intake/checkpoint"


def _docs(spark: SparkSession, root: str, folder: str, schema, multi_line: bool) -> DataFrame:
    """A feed's documents; a feed with no folder yet has none."""
    try:
        return read_bronze(spark, root, folder, schema, multi_line)
    except AnalysisException as e:
        if (e.getCondition() or "") != "PATH_NOT_FOUND":
            raise
    empty = spark.createDataFrame([], schema)
    none = F.lit(None)
    return empty.select("*", none.cast("string").alias(PULL_STAMP), none.cast("timestamp").alias(PULLED_AT),
                        none.cast("string").alias(PULL_FILE))


def conformed_candidates(
    spark: SparkSession,
    bronze_root: str,
    labels: dict[str, str] | None = None,
    strict: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """L1, first half: every document of both feeds to candidate rows with
    pull lineage."""
    a = _docs(spark, bronze_root, FEED_A_FOLDER, FEED_A_SCHEMA, multi_line)
    b = _docs(spark, bronze_root, FEED_B_FOLDER, FEED_B_SCHEMA, multi_line)
    return union_feeds(
        parse_feed_a(a, labels=labels, strict=strict, carry=LINEAGE),
        parse_feed_b(b, strict=strict, carry=LINEAGE),
    )


def build_silver(candidates: DataFrame) -> DataFrame:
    """L1, second half: accepted rows, deduped (real first, newest pull)."""
    return dedupe_observations(accepted(candidates, carry=LINEAGE))


def run(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    recent_window_days: int | None = RECENT_WINDOW_DAYS,
    labels: dict[str, str] | None = None,
    strict: bool = False,
    multi_line: bool = False,
    total_order: bool = False,
    incremental: bool = False,
    max_files_per_batch: int | None = None,
) -> dict[str, int]:
    """L4: the whole refresh. Returns row counts of every written table.

    Silver and long are written sorted by (source, indicator_id, obs_date)
    inside each file, wide by calendar_date; ``total_order`` adds a range
    shuffle so the files also follow one another in key order.

    ``incremental``: parse only the pulls landed since the last run (a file
    stream), append them to the conformed table, merge their good rows into
    silver and rebuild what they reach of long and wide (``plans.incremental``).
    The pointer (mode, last merged ingest id) is replaced only after all tables
    are complete, so a failure anywhere just redoes the merge.
    ``max_files_per_batch`` drains a large backlog of pulls in several
    committed micro-batches.

    Nothing is replaced unless the run can go on from what is there: the
    stream's checkpoint lives under ``out_root`` beside its table, a root
    belongs to one mode (recorded in the pointer), and a missing bronze root, or
    a missing half of checkpoint and table, is an error."""
    if incremental and (strict or multi_line):
        raise ValueError("incremental refresh reads JSON-lines bronze and keeps rejects; "
                         "strict / multi_line need a full run")
    root = bronze_root.rstrip("/")
    if not any(path_exists(spark, f"{root}/{f}") for f in (FEED_A_FOLDER, FEED_B_FOLDER)):
        raise FileNotFoundError(f"no bronze folder {FEED_A_FOLDER} or {FEED_B_FOLDER} under {bronze_root}")
    mode = "incremental" if incremental else "full"
    before = current(spark, out_root)
    if before is not None and before.info["mode"] != mode:
        raise ValueError(
            f"{out_root} was written by a {before.info['mode']} refresh; a {mode} one needs a root of its own"
        )
    if incremental:
        release = _merge_new_pulls(spark, bronze_root, out_root, before, recent_window_days, labels, total_order,
                                   max_files_per_batch)
        return dict(release.info["counts"])
    release = new_release(out_root)
    write_parquet(conformed_candidates(spark, bronze_root, labels, strict, multi_line), release.path("conformed"),
                  rows_a_file=dedupe.ROWS_A_FILE)
    conformed = read_gold(spark, release.path("conformed"))
    with scan_splits(spark, dedupe.DEDUPE_SPLIT):
        counts = {"silver": write_counted(enforce_not_null(build_silver(conformed)), release.path("silver"),
                                          SERIES_ORDER, total_order)}
    write_parquet(rejected(conformed, carry=LINEAGE), release.path("rejects"))
    silver = read_gold(spark, release.path("silver"))
    counts["indicators_long"] = write_counted(gold_long(silver), release.path("indicators_long"), SERIES_ORDER, total_order)
    counts["indicators_wide"] = write_counted(gold_wide(silver, recent_window_days), release.path("indicators_wide"),
                                              ["calendar_date"], total_order)
    publish(spark, release, {"mode": mode, "counts": counts}, None if before is None else before.info)
    expire(spark, release.root, [release.name] + ([] if before is None else [before.name]))
    return counts


# ------------------------------------------------------------ incremental

def _landed(spark: SparkSession, intake: Intake) -> DataFrame:
    """What has been landed; an empty table before the first pull has."""
    from indtables.streaming.bronze_stream import INGEST_ID

    if path_exists(spark, f"{intake.conformed}/_spark_metadata"):
        return read_gold(spark, intake.conformed)
    a, b = (spark.createDataFrame([], s).select(
        "*", F.lit(None).cast("string").alias(PULL_STAMP), F.lit(None).cast("timestamp").alias(PULLED_AT),
        F.lit(None).cast("string").alias(PULL_FILE)) for s in (FEED_A_SCHEMA, FEED_B_SCHEMA))
    none = union_feeds(parse_feed_a(a, carry=LINEAGE), parse_feed_b(b, carry=LINEAGE))
    return none.withColumn(INGEST_ID, F.lit(0).cast("long"))


def _check_intake(spark: SparkSession, intake: Intake, before: Release | None) -> None:
    """The checkpoint says which pulls are in the conformed table: going on
    with only one of the two would lose or repeat pulls."""
    table = path_exists(spark, f"{intake.conformed}/_spark_metadata")
    checkpoint = path_exists(spark, f"{intake.checkpoint}/metadata")
    committed = path_exists(spark, f"{intake.checkpoint}/commits/0")
    if table and not checkpoint:
        raise RuntimeError(f"{intake.conformed} has lost its checkpoint {intake.checkpoint}: refresh into a new root")
    if committed and not table or before is not None and before.info["counts"]["silver"] and not (table and checkpoint):
        raise RuntimeError(f"{intake.checkpoint} has lost its table {intake.conformed}: refresh into a new root")
    if before is None and not checkpoint and path_exists(spark, f"{intake.root.rstrip('/')}/releases"):
        raise RuntimeError(f"{intake.root} holds tables of an unknown run: refresh into a new root")


def _merge_new_pulls(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    before: Release | None,
    recent_window_days: int | None,
    labels,
    total_order: bool = False,
    max_files_per_batch: int | None = None,
) -> Release:
    """Land the new pulls, publish the release that has their good rows merged in."""
    from indtables.streaming.bronze_stream import INGEST_ID, conform_new_pulls

    intake = Intake(out_root)
    _check_intake(spark, intake, before)
    if before is None and any(packs(spark, bronze_root, f) for f in (FEED_A_FOLDER, FEED_B_FOLDER)):
        raise ValueError(f"{bronze_root} has packed pulls, which an incremental refresh does not list: "
                         "a new root needs a full one")
    merged_through = -1 if before is None else before.info["merged_through"]
    ingest_id = max(int(time.time() * 1000), merged_through + 1)
    conform_new_pulls(spark, bronze_root, intake.conformed, intake.checkpoint, labels=labels,
                      max_files_per_batch=max_files_per_batch, ingest_id=ingest_id)
    # Only rows landed after the last merge (older files skip by their
    # row-group statistics on the ingest id).
    landed = _landed(spark, intake).filter(F.col(INGEST_ID) > merged_through)
    return incremental.merge_pulls(spark, out_root, before, accepted(landed, carry=LINEAGE), ingest_id,
                                   recent_window_days, total_order)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Refresh silver and gold from bronze.")
    p.add_argument("bronze_root")
    p.add_argument("out_root")
    p.add_argument("--recent-window-days", type=int, default=RECENT_WINDOW_DAYS)
    p.add_argument("--strict", action="store_true", help="fail on the first bad observation")
    p.add_argument("--multi-line", action="store_true", help="bronze files hold one pretty-printed document")
    p.add_argument("--total-order", action="store_true")
    p.add_argument("--incremental", action="store_true", help="parse only pulls landed since the last run")
    p.add_argument("--max-files-per-batch", type=int, default=None, help="incremental: bound each micro-batch")
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    counts = run(spark, args.bronze_root, args.out_root, args.recent_window_days, strict=args.strict,
                 multi_line=args.multi_line, total_order=args.total_order, incremental=args.incremental,
                 max_files_per_batch=args.max_files_per_batch)
    print(counts)


if __name__ == "__main__":
    main()

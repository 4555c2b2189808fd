"""Stress run: overlapping pulls plus one hot key, then dedupe -> long -> wide.

Every `lineitem` observation is landed STRESS_PULLS times (each pull with a
revised value and its own pull time), plus STRESS_HOT_ROWS rows on one single
(series, day) key. Prints one line per step with its time. Scratch data goes
under the session's spark.checkpoint.dir.

    STRESS_SF_DIR=/root/testdata/sf0.1 STRESS_PULLS=20 STRESS_HOT_ROWS=6000000 python tools/stress.py
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from indtables.operators.long import gold_long  # noqa: E402
from indtables.operators.silver import dedupe_observations  # noqa: E402
from indtables.operators.wide import gold_wide  # noqa: E402
from indtables.session import ensure_checkpoint_dir, local_session  # noqa: E402
from indtables.sources.tables import lineitem_observations, read_table  # noqa: E402

SF_DIR = os.environ.get("STRESS_SF_DIR", "/root/testdata/sf0.1")
PULLS = int(os.environ.get("STRESS_PULLS", "20"))
HOT_ROWS = int(os.environ.get("STRESS_HOT_ROWS", "6000000"))


def timed(label, fn):
    t = time.perf_counter()
    out = fn()
    print(f"{label}: {time.perf_counter() - t:.1f}s", flush=True)
    return out


def main() -> None:
    spark = local_session("local[8]", 64, app="indtables-stress")
    root = f"{ensure_checkpoint_dir(spark)}/stress-{os.getpid()}"
    base = lineitem_observations(read_table(spark, SF_DIR, "lineitem")).select(
        "source", "indicator_id", "indicator_label", "obs_date", "value", "is_fallback")
    pull = F.col("pull")
    pulls = base.withColumn("pull", F.explode(F.sequence(F.lit(1), F.lit(PULLS)))).select(
        "source", "indicator_id", "indicator_label", "obs_date", (F.col("value") + pull * 0.01).alias("value"),
        "is_fallback", (F.lit("2026-01-01").cast("timestamp") + F.make_interval(days=pull)).alias("_pulled_at"),
        F.concat(F.lit("part-"), pull.cast("string")).alias("_pull_file"))
    hot = spark.range(HOT_ROWS).select(
        F.lit("lineitem").alias("source"), F.lit("hot").alias("indicator_id"), F.lit("hot").alias("indicator_label"),
        F.lit("1998-01-01").cast("date").alias("obs_date"), F.col("id").cast("double").alias("value"),
        (F.col("id") % 3 != 0).alias("is_fallback"),
        (F.lit("2026-01-01").cast("timestamp") + F.make_interval(days=(F.col("id") % 20).cast("int")))
        .alias("_pulled_at"),
        F.lit("part-hot").alias("_pull_file"))
    timed("land raw", lambda: pulls.unionByName(hot).write.parquet(f"{root}/raw"))
    raw = spark.read.parquet(f"{root}/raw")
    print("raw rows", raw.count(), flush=True)
    timed("dedupe + write silver", lambda: dedupe_observations(raw).write.parquet(f"{root}/silver"))
    silver = spark.read.parquet(f"{root}/silver")
    print("silver rows", silver.count(), "hot key:", silver.filter("indicator_id = 'hot'").collect(), flush=True)
    timed("gold long", lambda: gold_long(silver).write.format("noop").mode("overwrite").save())
    timed("gold wide", lambda: gold_wide(silver).write.format("noop").mode("overwrite").save())
    spark.stop()


if __name__ == "__main__":
    main()

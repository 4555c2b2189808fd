"""The scale properties, pinned on the physical plans."""

import datetime as dt
import os

from pyspark.sql import functions as F

from indtables.operators.long import gold_long
from indtables.operators.silver import dedupe_observations
from indtables.operators.wide import gold_wide
from window_fill import gold_wide_by_window
from indtables.sinks.writers import write_parquet


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def observations(spark, n_hot=30000, n_cold=60000):
    """One key (series 'hot', one day) holds a third of all rows."""
    hot = spark.range(n_hot).select(
        F.lit("s").alias("source"), F.lit("hot").alias("indicator_id"), F.lit("hot").alias("indicator_label"),
        F.lit(dt.date(2024, 1, 1)).alias("obs_date"), F.col("id").cast("double").alias("value"),
        (F.col("id") % 2 == 0).alias("is_fallback"))
    cold = spark.range(n_cold).select(
        F.lit("s").alias("source"), (F.col("id") % 50).cast("string").alias("indicator_id"),
        (F.col("id") % 50).cast("string").alias("indicator_label"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 1500).cast("int")).alias("obs_date"),
        F.col("id").cast("double").alias("value"), F.lit(False).alias("is_fallback"))
    return hot.unionByName(cold)


def test_dedupe_combines_before_the_shuffle(spark):
    p = plan(dedupe_observations(observations(spark)))
    # The tree prints top-down: the Partial limit must appear after (below) the exchange.
    assert "Partial" in p and "Final" in p
    assert p.index("Exchange hashpartitioning") < p.index("Partial")


def test_hot_key_dedupes_to_one_row(spark):
    silver = dedupe_observations(observations(spark))
    hot = silver.filter("indicator_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["is_fallback"] is False and hot[0]["value"] == 29999.0
    # cold rows: 50 series x 1,500 days, each (series, day) hit by 0.8 rows on average
    expected = observations(spark).select("indicator_id", "obs_date").distinct().count()
    assert silver.count() == expected


def test_long_has_one_exchange_and_one_sort_from_silver(spark, scratch):
    path = write_parquet(dedupe_observations(observations(spark)), os.path.join(scratch, "silver"))
    long_ = gold_long(spark.read.parquet(path))
    for df in (long_, long_.sortWithinPartitions("source", "indicator_id", "obs_date")):
        p = plan(df)  # writing it sorted by the table key needs no second sort
        assert p.count("Exchange hashpartitioning") == 1
        assert p.count("Sort [") == 1
        assert p.count("Window [") == 1


def test_wide_never_funnels_into_one_partition(spark, scratch):
    path = write_parquet(dedupe_observations(observations(spark)), os.path.join(scratch, "silver"))
    silver = spark.read.parquet(path)
    fast = plan(gold_wide(silver, 400))
    assert "SinglePartition" not in fast
    assert "PushedFilters: [IsNotNull(obs_date), GreaterThanOrEqual(obs_date," in fast
    slow = plan(gold_wide_by_window(silver, 400))
    assert "SinglePartition" in slow  # what the rewrite avoids
    assert sorted(gold_wide(silver, 400).collect()) == sorted(gold_wide_by_window(silver, 400).collect())


def test_report_reads_only_needed_columns(spark, scratch):
    from indtables.operators.reports import report_inpc_shipped

    path = write_parquet(gold_long(dedupe_observations(observations(spark))), os.path.join(scratch, "long"))
    p = plan(report_inpc_shipped(spark.read.parquet(path), "hot", sum_scale=8))
    assert "ReadSchema: struct<indicator_label:string,obs_date:date,change_pct:double>" in p
    assert "PushedFilters: [IsNotNull(indicator_label), EqualTo(indicator_label,hot)]" in p
    assert "HashAggregate" in p and "SortAggregate" not in p

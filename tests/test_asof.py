"""As-of lookup of any probes, and silver stored in buckets of its series."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from indtables.operators.asof import SPLIT, asof_lookup, split_rows
from indtables.operators.long import gold_long
from indtables.schemas import SILVER_SCHEMA
from indtables.sinks.writers import read_in_buckets, write_in_buckets

T0 = dt.datetime(2024, 1, 1)


def stamp(i):
    return T0 + dt.timedelta(hours=i)


def sides(spark, seed, n_obs, n_probes):
    """A third of all probes ask one series at one moment."""
    rnd = random.Random(seed)
    obs = [(rnd.choice("abc"), stamp(rnd.randint(0, 400)), rnd.choice([None, 0.0, rnd.uniform(-9, 9)])) for _ in range(n_obs)]
    obs += [(None, stamp(3), 1.0), ("a", None, 1.0), ("b", stamp(50), 1.0), ("b", stamp(50), 2.0)]
    probes = [(i, rnd.choice("abcd"), stamp(rnd.randint(-20, 420))) for i in range(n_probes)]
    probes += [(n_probes + i, "a", stamp(200)) for i in range(n_probes // 2)]
    probes += [(-1, None, stamp(5)), (-2, "a", None), (-3, "b", stamp(50)), (-3, "b", stamp(50))]
    return (spark.createDataFrame(obs, "k string, at timestamp, v double"),
            spark.createDataFrame(probes, "id long, series string, time timestamp"), obs, probes)


def brute(obs, probes):
    out = []
    for i, s, t in probes:
        best = max(((a, v) for k, a, v in obs if None not in (k, a, v, s, t) and k == s and a <= t), default=(None, None))
        out.append((i, s, t, *best))
    return sorted(map(repr, out))


@pytest.mark.parametrize("splits", [1, 7, 40])
def test_asof_is_the_latest_at_or_before(spark, splits):
    o, p, obs, probes = sides(spark, splits, 300, 400)
    got = asof_lookup(p, o, ["series"], "time", ["k"], "at", "v", ("at", "v"), splits=splits)
    assert got.columns == ["id", "series", "time", "at", "v"]
    assert sorted(map(repr, map(tuple, got.collect()))) == brute(obs, probes)


def test_asof_edges(spark):
    o, p, obs, probes = sides(spark, 0, 30, 30)
    none = asof_lookup(p, o.limit(0), ["series"], "time", ["k"], "at", "v").collect()
    assert len(none) == len(probes) and {(r["asof_date"], r["asof_value"]) for r in none} == {(None, None)}
    assert asof_lookup(p.limit(0), o, ["series"], "time", ["k"], "at", "v").collect() == []
    with pytest.raises(ValueError, match="already have"):
        asof_lookup(p, o, ["series"], "time", ["k"], "at", "v", ("id", "v"))
    # values carried over many splits without an observation of their own
    one = spark.createDataFrame([("a", stamp(0), 5.0)], o.schema)
    far = spark.createDataFrame([(i, "a", stamp(i)) for i in range(500)], p.schema)
    got = asof_lookup(far, one, ["series"], "time", ["k"], "at", "v", splits=25)
    assert got.filter("asof_value = 5.0").count() == 500
    odd = p.withColumnsRenamed({"series": "_value", "time": "a.b"})  # names of its own
    got = asof_lookup(odd, o, ["_value"], "a.b", ["k"], "at", "v").select("id", "_value", "`a.b`", "asof_date", "asof_value")
    assert sorted(map(repr, map(tuple, got.collect()))) == brute(obs, probes)


def test_a_hot_moment_is_many_splits(spark):
    """30,000 probes of one series at one moment, as the lookup splits them."""
    rows = spark.range(30_000).select(F.lit("a").alias("_s0"), F.lit(stamp(5)).alias("_time"), F.lit(1).alias("_kind"),
                                      F.xxhash64("id").alias("_salt"))
    sizes = [r["count"] for r in split_rows(rows, ["_s0"], 10).groupBy(SPLIT).count().collect()]
    assert len(sizes) >= 9 and max(sizes) < 6_000
    plan = asof_lookup(rows.select(F.col("_s0").alias("s"), F.col("_time").alias("t")),
                       rows.select(F.col("_s0").alias("k"), F.col("_time").alias("at"), F.lit(1.0).alias("v")),
                       ["s"], "t", ["k"], "at", "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
    assert f"hashpartitioning(_s0#" in plan and SPLIT in plan


def test_stored_order_saves_exchange_and_sort(spark, scratch):
    rnd = random.Random(4)
    rows = [("s", str(rnd.randint(0, 40)), "l", dt.date(2020, 1, 1) + dt.timedelta(days=i // 20), float(i % 13), False)
            for i in range(8000)]
    silver = spark.createDataFrame(rows, SILVER_SCHEMA).dropDuplicates(["indicator_id", "obs_date"])
    silver.write.parquet(os.path.join(scratch, "plain"))
    silver = spark.read.parquet(os.path.join(scratch, "plain"))
    by, path = ["source", "indicator_id"], os.path.join(scratch, "buckets")
    for _ in range(2):  # replaced on rerun
        write_in_buckets(silver, path, by, [*by, "obs_date"], 8)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 8  # one file each
    stored = read_in_buckets(spark, path)
    long_ = gold_long(stored)
    for df in (long_, long_.sortWithinPartitions(*by, "obs_date")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange" not in plan and "Sort [" not in plan
    assert sorted(map(repr, long_.collect())) == sorted(map(repr, gold_long(silver).collect()))
    assert spark.read.parquet(path).count() == stored.count() == silver.count()  # plain Parquet for others
    with pytest.raises(FileNotFoundError):
        read_in_buckets(spark, os.path.join(scratch, "plain"))

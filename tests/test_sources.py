"""Synthetic series, fallback choice, bronze/gold/CSV scans, sinks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from indtables.operators.conform import accepted, parse_feed_a, parse_feed_b
from indtables.operators.long import gold_long
from indtables.schemas import FEED_A_SCHEMA, FEED_B_SCHEMA, LONG_COLUMNS
from indtables.sinks.writers import write_bronze, write_csv, write_parquet
from indtables.sources.bronze import read_bronze
from indtables.sources.gold import read_csv_typed, read_gold, read_wide_csv
from indtables.sources.synthetic import (
    FEED_B_REGISTRY,
    choose_fallback,
    feed_a_fallback_docs,
    feed_b_fallback_docs,
    pull_start,
    registry_frame,
)


def pulls(spark, start, end):
    return spark.createDataFrame([(1, start, end)], "pull_id int, start_date date, end_date date")


def test_feed_a_fallback_covers_full_range_and_parses(spark):
    docs = feed_a_fallback_docs(pulls(spark, dt.date(2026, 3, 1), dt.date(2026, 3, 10)), keep=["pull_id"])
    rows = accepted(parse_feed_a(docs)).collect()
    fx = [r for r in rows if r["indicator_id"] == "SF43718"]
    assert len(fx) == 10 and {r["value"] for r in fx} == {17.5}
    assert all(r["is_fallback"] for r in rows)
    monthly = [r for r in rows if r["indicator_id"] == "SP1"]
    assert [r["obs_date"] for r in monthly] == [dt.date(2026, 3, 1)]
    assert monthly[0]["value"] == 130.0 and monthly[0]["indicator_label"] == "inpc_general"


def test_month_starts_and_empty_range(spark):
    docs = feed_a_fallback_docs(pulls(spark, dt.date(2026, 1, 2), dt.date(2026, 4, 1)))
    got = sorted(r["obs_date"] for r in accepted(parse_feed_a(docs)).filter("indicator_id = 'SP1'").collect())
    assert got == [dt.date(2026, 2, 1), dt.date(2026, 3, 1), dt.date(2026, 4, 1)]
    empty = feed_a_fallback_docs(pulls(spark, dt.date(2026, 2, 1), dt.date(2026, 1, 1)))
    assert parse_feed_a(empty).count() == 0


def test_pull_window_is_401_days(spark):
    df = spark.createDataFrame([(dt.date(2026, 8, 28),)], "end_date date").withColumn(
        "start_date", pull_start(F.col("end_date")))
    docs = feed_a_fallback_docs(df)
    assert accepted(parse_feed_a(docs)).filter("indicator_id = 'SF43718'").count() == 401


def test_registry_fallback_one_doc_per_entry(spark):
    docs = feed_b_fallback_docs(registry_frame(spark))
    assert docs.count() == len(FEED_B_REGISTRY)
    rows = accepted(parse_feed_b(docs)).collect()
    assert len(rows) == 6 * len(FEED_B_REGISTRY)
    assert {r["obs_date"] for r in rows} == {dt.date(2026, m, 1) for m in range(1, 7)}
    assert {r["indicator_label"] for r in rows} == {e[1] for e in FEED_B_REGISTRY}


def test_choose_fallback_is_all_or_nothing_per_unit(spark):
    real = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "source string, value double")
    synth = spark.createDataFrame([("a", 9.0), ("b", 9.0), ("c", 9.0)], "source string, value double")
    failed = spark.createDataFrame([("b",), ("c",)], "source string")
    out = sorted(tuple(r) for r in choose_fallback(real, synth, failed, "source").collect())
    assert out == [("a", 1.0), ("a", 2.0), ("b", 9.0), ("c", 9.0)]


def test_bronze_append_keeps_every_pull(spark, scratch):
    src = spark.read.schema(FEED_A_SCHEMA).option("multiLine", True).json(str(FIXTURES / "feed_a_sample.json"))
    write_bronze(src, scratch, "banxico")
    write_bronze(src, scratch, "banxico")
    files = [f for f in os.listdir(os.path.join(scratch, "banxico")) if f.endswith(".json")]
    assert len(files) == 2 and len(set(files)) == 2
    docs = read_bronze(spark, scratch, "banxico", FEED_A_SCHEMA)
    assert docs.count() == 2
    assert {"_pulled_at", "_pull_file"} <= set(docs.columns)
    assert accepted(parse_feed_a(docs)).count() == 10


def test_bronze_multiline_documents(spark):
    docs = read_bronze(spark, str(FIXTURES), "", FEED_B_SCHEMA, multi_line=True).filter(F.col("Series").isNotNull())
    assert accepted(parse_feed_b(docs)).count() == 3


def test_malformed_json_fails(spark, scratch):
    os.makedirs(os.path.join(scratch, "banxico"))
    with open(os.path.join(scratch, "banxico", "bad.json"), "w") as f:
        f.write('{"bmx": {"series": [ oops\n')
    with pytest.raises(Exception):
        read_bronze(spark, scratch, "banxico", FEED_A_SCHEMA).collect()


def test_gold_scan_missing_path_is_clear(spark, scratch):
    with pytest.raises(FileNotFoundError, match="refresh"):
        read_gold(spark, os.path.join(scratch, "nothing"))
    os.makedirs(os.path.join(scratch, "empty"))
    with pytest.raises(FileNotFoundError):
        read_gold(spark, os.path.join(scratch, "empty"))


def test_parquet_and_csv_round_trip(spark, scratch):
    rows = [("s", "i", "l", dt.date(2026, 1, d), float(d) / 3, d % 2 == 0) for d in range(1, 6)]
    silver = spark.createDataFrame(rows, "source string, indicator_id string, indicator_label string, "
                                         "obs_date date, value double, is_fallback boolean")
    long_ = gold_long(silver)
    want = sorted(long_.collect())
    p = write_parquet(long_, os.path.join(scratch, "long"), order_by=["source", "indicator_id", "obs_date"])
    write_parquet(long_, p)  # replace, not append
    assert sorted(read_gold(spark, p).collect()) == want
    c = write_csv(long_, os.path.join(scratch, "long_csv"))
    back = read_csv_typed(spark, c)
    assert back.columns == LONG_COLUMNS
    assert sorted(back.collect()) == want  # NULL change_pct survives as an empty field
    text = "".join(open(os.path.join(c, f)).read() for f in os.listdir(c) if f.endswith(".csv"))
    assert "true" in text and "2026-01-01" in text


def test_wide_csv_round_trip(spark, scratch):
    wide = spark.createDataFrame([(dt.date(2026, 1, 1), None, 2.5), (dt.date(2026, 1, 2), 1.0, 2.5)],
                                 "calendar_date date, `a b` double, c double")
    back = read_wide_csv(spark, write_csv(wide, os.path.join(scratch, "w")))
    assert back.columns == ["calendar_date", "a b", "c"]
    assert sorted(back.collect()) == sorted(wide.collect())


def test_gold_scan_other_errors_pass_through(spark, scratch):
    bad = os.path.join(scratch, "corrupt")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "wb") as f:
        f.write(b"not a parquet file at all")
    with pytest.raises(Exception) as info:
        read_gold(spark, bad).collect()
    assert not isinstance(info.value, FileNotFoundError)


def test_single_file_csv_of_a_spread_out_table(spark, scratch):
    from indtables.sinks.writers import write_csv

    df = spark.range(1000, numPartitions=7).withColumnRenamed("id", "n")
    path = write_csv(df, os.path.join(scratch, "one"), order_by=["n"], single_file=True)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    assert open(os.path.join(path, parts[0])).read().split() == ["n", *map(str, range(1000))]



def test_csv_scan_missing_path_is_clear(spark, scratch):
    with pytest.raises(FileNotFoundError, match="refresh"):
        read_csv_typed(spark, os.path.join(scratch, "no-csv"))

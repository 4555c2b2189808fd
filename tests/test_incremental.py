"""Change-driven refresh: long by touched months, wide from a carried state, the
pointer; equal to a full run after revisions, also when a run dies half way."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import docs_frame
from indtables.operators import silver as dedupe
from indtables.operators.buckets import MONTH, gold_long_bucketed
from indtables.operators.long import gold_long
from indtables.plans import incremental, refresh
from indtables.plans.incremental import STORED_SILVER, stored
from indtables.plans.refresh import published, run
from indtables.schemas import SILVER_SCHEMA
from indtables.session import scan_splits
from indtables.sinks.publish import POINTER, current, expire, read_small, write_small
from indtables.sinks.writers import write_bronze, write_counted, write_parquet


def land(spark, bronze, series, stamp, fallback=False):
    """One feed A pull: {id: [(day, value)]}."""
    doc = {"is_fallback": fallback, "pulled_at": stamp, "bmx": {"series": [
        {"idSerie": k, "datos": [{"fecha": d.strftime("%d/%m/%Y"), "dato": str(v)} for d, v in points]}
        for k, points in series.items()]}}
    write_bronze(docs_frame(spark, [doc], "a").coalesce(1), bronze, "banxico")


def tables(spark, root):
    now = published(spark, root)
    return {t: sorted(map(repr, getattr(now, t)().collect())) for t in ("silver", "long", "wide", "rejects")}


def long_files(spark, release):
    """Data files of each month's folder."""
    top = release.path("indicators_long")
    return {d: sorted(f for f in os.listdir(os.path.join(top, d)) if f.endswith(".parquet"))
            for d in os.listdir(top) if d.startswith(MONTH)}


def day(y, m, d):
    return dt.date(y, m, d)


LABELS = {"D": "daily", "M": "monthly", "Y": "yearly", "X": "daily"}  # two series share a label


def history(first=day(2024, 1, 10), until=day(2024, 6, 10)):
    """Months are folders: a short history keeps the runs short."""
    days = [first + dt.timedelta(days=i) for i in range((until - first).days + 1)]
    return {"D": [(d, i % 17 + 1) for i, d in enumerate(days) if d.weekday() < 5],
            "M": [(d, d.month) for d in days if d.day == 1],
            "Y": [(day(y, 1, 1), y) for y in (1995, 2001, 2023)]}


def test_runs_with_revisions_equal_a_full_run(spark, scratch):
    bronze, inc = os.path.join(scratch, "bronze"), os.path.join(scratch, "inc")
    all_ = history(day(2023, 5, 20))
    # two halves, then revisions: of old days, of the last day before a gap, of a
    # month's first row; a series that starts later, a text that is no number
    pulls = [
        {k: [p for p in v if p[0] < day(2024, 1, 1)] for k, v in all_.items()},
        {k: [p for p in v if p[0] >= day(2023, 12, 1)] for k, v in all_.items()},
        {"D": [(day(2023, 7, 31), 99.5), (day(2023, 6, 30), 98.5)], "Y": [(day(2001, 1, 1), 7.5), (day(1993, 5, 5), 3.5)],
         "X": [(day(2024, 6, 12), 5.5)], "M": [(day(2023, 9, 1), 0)]},
        {"D": [(day(2024, 6, 11), 42.5), (day(2023, 5, 25), "N/E"), (day(2024, 2, 29), 77.5)], "Q": [(day(2023, 3, 3), "x")]},
    ]
    for i, pull in enumerate(pulls):
        land(spark, bronze, pull, f"2024070{i}T000000")
        counts = run(spark, bronze, inc, incremental=True, labels=LABELS)
        if i:
            full = os.path.join(scratch, f"full{i}")
            assert counts == run(spark, bronze, full, labels=LABELS)
            assert tables(spark, inc) == tables(spark, full), i
    land(spark, bronze, {"D": [(day(2024, 6, 11), 1)]}, "20240601T000000")  # an older pull comes late: changes nothing
    before = published(spark, inc).release
    run(spark, bronze, inc, incremental=True, labels=LABELS)
    now = published(spark, inc).release
    assert now.name != before.name and now.info["behind"]["long"] == []
    assert tables(spark, inc) == tables(spark, full)
    # another window: the state is not of use, the result is
    short = os.path.join(scratch, "short")
    assert run(spark, bronze, inc, 30, incremental=True, labels=LABELS) == run(spark, bronze, short, 30, labels=LABELS)
    assert tables(spark, inc) == tables(spark, short)


def test_a_label_that_moves(spark, scratch):
    """A revised row takes another label: the carried state is rebuilt."""
    bronze, inc, full = (os.path.join(scratch, x) for x in ("bronze", "inc", "full"))
    land(spark, bronze, history(), "20240701T000000")
    run(spark, bronze, inc, 60, incremental=True)
    land(spark, bronze, {"Y": [(day(2001, 1, 1), 1.5)], "D": [(day(2024, 2, 1), 8)]}, "20240702T000000")
    run(spark, bronze, inc, 60, incremental=True, labels={"Y": "moved"})
    got = published(spark, inc)
    # what a full run over rows so labelled gives
    rows = got.silver()
    want = refresh.gold_wide(rows, 60)
    assert got.wide().columns == want.columns and "moved" in want.columns
    assert sorted(map(repr, got.wide().collect())) == sorted(map(repr, want.collect()))
    run(spark, bronze, full)
    assert sorted(map(repr, got.long().drop("indicator_label").collect())) == sorted(
        map(repr, published(spark, full).long().drop("indicator_label").collect()))


def test_only_reached_months_are_written(spark, scratch):
    bronze, inc = os.path.join(scratch, "bronze"), os.path.join(scratch, "inc")
    land(spark, bronze, history(), "20240701T000000")
    for i in range(2):  # both slots exist
        land(spark, bronze, {"D": [(day(2024, 6, 11 + i), 5)]}, f"2024070{2 + i}T000000")
        run(spark, bronze, inc, incremental=True)
    land(spark, bronze, {"D": [(day(2024, 3, 15), 50)], "M": [(day(2024, 2, 1), 9)]}, "20240705T000000")
    old = published(spark, inc).release
    target = incremental.Slots.of(inc, old).new
    before = long_files(spark, target)
    run(spark, bronze, inc, incremental=True)
    now = published(spark, inc).release
    after = long_files(spark, now)
    assert now.name == target.name
    written = {m for m in after if after[m] != before.get(m)}
    # the frames of March 15 and February 1, M's next row (March 1), and June, where this slot lagged
    assert written == {f"{MONTH}={m}" for m in (202402, 202403, 202404, 202406)}
    assert now.info["behind"]["long"] == [202402, 202403, 202404] and now.info["behind"]["silver"] == [202402, 202403]


def test_reads_are_pruned_to_months(spark, scratch):
    bronze, inc = os.path.join(scratch, "bronze"), os.path.join(scratch, "inc")
    land(spark, bronze, history(), "20240701T000000")
    run(spark, bronze, inc, incremental=True)
    release = published(spark, inc).release
    silver, tails = stored(spark, release, "silver", STORED_SILVER), stored(spark, release, "tails", incremental.STORED_TAILS)
    plan = incremental.gold_long_of_months(silver, tails, [202403])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and MONTH in line]
    assert scans and all(f"PartitionFilters: [{MONTH}#" in s or f"PartitionFilters: [isnotnull({MONTH}" in s for s in scans)
    assert "hashpartitioning(source" in plan and "_bucket" in plan
    seeds = stored(spark, release, "wide_state", incremental.SEEDS)
    inside = incremental.wide_of_window(silver, seeds, day(2024, 5, 1), day(2024, 6, 10))
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert f"({MONTH}#" in plan and ">= 202405)" in plan
    # the state holds what a scan of all rows before the window would find
    cutoff = dt.date.fromisoformat(release.info["cutoff"])
    assert sorted(seeds.collect()) == sorted(incremental.seeds_before(silver, cutoff).collect())


@pytest.mark.parametrize("where", ["_write_long", "_write_wide", "publish"])
def test_a_run_that_dies(spark, scratch, monkeypatch, where):
    """Between any two writes: readers keep their release; the next run, with a
    pull that takes some of the changes back, agrees with a full one."""
    bronze, inc, full = (os.path.join(scratch, x) for x in ("bronze", "inc", "full"))
    land(spark, bronze, history(), "20240701T000000")
    run(spark, bronze, inc, incremental=True)
    land(spark, bronze, {"D": [(day(2024, 6, 11), 5)]}, "20240702T000000")
    run(spark, bronze, inc, incremental=True)
    seen = tables(spark, inc)
    land(spark, bronze, {"D": [(day(2024, 3, 15), 50), (day(2024, 6, 11), 6)]}, "20240703T000000")
    real, calls = getattr(incremental, where), []

    def dies(*args, **kwargs):
        calls.append(where)
        if where == "publish" and len(calls) < 3:  # the last one: all tables are written
            return real(*args, **kwargs)
        raise OSError("executor lost for good")

    monkeypatch.setattr(incremental, where, dies)
    with pytest.raises(OSError):
        run(spark, bronze, inc, incremental=True)
    monkeypatch.setattr(incremental, where, real)
    assert tables(spark, inc) == seen
    land(spark, bronze, {"D": [(day(2024, 6, 11), 5), (day(2024, 4, 30), 3)]}, "20240704T000000")
    assert run(spark, bronze, inc, incremental=True) == run(spark, bronze, full)
    assert tables(spark, inc) == tables(spark, full)


def test_a_full_run_publishes_all_or_nothing(spark, scratch, monkeypatch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land(spark, bronze, history(), "20240701T000000")
    run(spark, bronze, out)
    reader, seen = published(spark, out), tables(spark, out)
    land(spark, bronze, {"D": [(day(2024, 6, 11), 5)]}, "20240702T000000")

    def dies(*args, **kwargs):
        raise OSError("driver lost")

    real = refresh.gold_wide
    monkeypatch.setattr(refresh, "gold_wide", dies)  # silver and long are written by then
    with pytest.raises(OSError):
        run(spark, bronze, out)
    assert tables(spark, out) == seen and current(spark, out).name == reader.release.name
    monkeypatch.setattr(refresh, "gold_wide", real)
    run(spark, bronze, out)
    assert tables(spark, out) != seen
    assert reader.long().count() == len(seen["long"])  # resolved before: still that release
    left = os.listdir(os.path.join(out, "releases"))
    assert len(left) == 3 and {reader.release.name, current(spark, out).name} < set(left)  # and the dead run's
    run(spark, bronze, out)
    assert reader.release.name not in os.listdir(os.path.join(out, "releases"))
    keep = [current(spark, out).name]
    assert len(expire(spark, out, keep, unfinished_s=-60)) == 2 and os.listdir(os.path.join(out, "releases")) == keep
    with pytest.raises(FileNotFoundError):
        reader.long()


def test_two_refreshes_at_once_are_noticed(spark, scratch, monkeypatch):
    bronze, out = os.path.join(scratch, "bronze"), os.path.join(scratch, "out")
    land(spark, bronze, history(), "20240701T000000")
    run(spark, bronze, out)
    real = refresh.gold_wide

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(refresh, "gold_wide", real)
        run(spark, bronze, out)
        return real(*args, **kwargs)

    monkeypatch.setattr(refresh, "gold_wide", meanwhile)
    with pytest.raises((RuntimeError, Exception), match="another refresh"):
        run(spark, bronze, out)


def test_small_files(spark, scratch):
    path = os.path.join(scratch, POINTER)
    assert read_small(spark, path) is None
    for text in ("one", "two: ñ\n", ""):
        write_small(spark, path, text)
        assert read_small(spark, path) == text
    assert [f for f in os.listdir(scratch) if not f.endswith(".crc")] == [POINTER]
    assert expire(spark, scratch, []) == []


def test_rows_are_counted_while_they_are_written(spark, scratch):
    sc = spark.sparkContext

    def jobs(group, work):
        sc.setJobGroup(group, group)
        out = work()
        n = len(sc.statusTracker().getJobIdsForGroup(group))
        sc.setLocalProperty("spark.jobGroup.id", None)
        return out, n

    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    _, plain = jobs("plain", lambda: write_parquet(df, os.path.join(scratch, "p"), ["k"]))
    n, counted = jobs("counted", lambda: write_counted(df, os.path.join(scratch, "c"), ["k"]))
    assert n == 1000 and counted == plain  # no job more than the write itself
    for empty in (df.limit(0), df.filter("id < 0"), spark.createDataFrame([], "a int")):
        assert write_counted(empty, os.path.join(scratch, "e")) == 0


def silver_rows(spark, n_series, seed, span=4000, rate=0.3):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_series):
        share = rate if s else 0.9
        for i in range(span):
            if rnd.random() < (share if s % 3 else share / 40):
                rows.append(("s", str(s), f"l{s}", day(1965, 1, 1) + dt.timedelta(days=i), rnd.choice([0.0, rnd.uniform(-5, 5)]), False))
    return spark.createDataFrame(rows, SILVER_SCHEMA)


@pytest.mark.parametrize("bucket_days", [30, 97, 3652])
def test_bucketed_long_is_gold_long(spark, scratch, bucket_days):
    path = write_parquet(silver_rows(spark, 6, bucket_days), os.path.join(scratch, "silver"))
    silver = spark.read.parquet(path)
    got = gold_long_bucketed(silver, bucket_days)
    assert got.columns == gold_long(silver).columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, gold_long(silver).collect()))  # to the bit
    exact = [sorted(map(repr, f(silver, mean_scale=2).collect())) for f in (gold_long_bucketed, gold_long)]
    assert exact[0] == exact[1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    last = [line for line in plan.splitlines() if "Window" in line and "rolling" in line.lower() or "avg(" in line]
    assert last and "_bucket" in last[0]


def test_one_long_series_is_many_tasks(spark):
    """400 years of days of one series: no window partition above a bucket and its halo."""
    silver = spark.range(146_000).select(
        F.lit("s").alias("source"), F.lit("k").alias("indicator_id"), F.lit("k").alias("indicator_label"),
        F.date_add(F.lit(day(1700, 1, 1)), F.col("id").cast("int")).alias("obs_date"),
        (F.col("id") % 101).cast("double").alias("value"), F.lit(False).alias("is_fallback"))
    got = gold_long_bucketed(silver, 3652)
    want = gold_long(silver)
    cols = [F.count("*"), F.sum(F.hash(*got.columns).cast("long"))]
    assert got.agg(*cols).first() == want.agg(*cols).first()
    with pytest.raises(ValueError, match="at least 30"):
        gold_long_bucketed(silver, 10)


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_the_dedupe_sorts_a_bounded_share_of_the_pulls(spark, scratch, monkeypatch, mode):
    """However coarse the session's splits are: files of few rows, a few files a task."""
    bronze, plain, bounded = (os.path.join(scratch, x) for x in ("bronze", "plain", "bounded"))
    for stamp in "123":
        land(spark, bronze, history() if stamp != "2" else {"D": [(day(2024, 2, 1), -5)]}, stamp)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    sc = spark.sparkContext

    def most_tasks(root):
        sc.setJobGroup(root, root)
        run(spark, bronze, root, incremental=mode == "incremental")
        sc.setLocalProperty("spark.jobGroup.id", None)
        seen = sc.statusTracker()
        infos = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup(root) for s in seen.getJobInfo(j).stageIds]
        return max(i.numTasks for i in infos if i is not None)

    run(spark, bronze, plain, incremental=mode == "incremental")
    monkeypatch.setattr(dedupe, "ROWS_A_FILE", 10)
    monkeypatch.setattr(dedupe, "DEDUPE_SPLIT", 1 << 12)
    assert most_tasks(bounded) >= 20  # 230 rows, 10 a file, a file a task
    assert tables(spark, bounded) == tables(spark, plain)
    assert spark.conf.get(key) == before


def test_scan_splits_never_widens_and_gives_the_setting_back(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for said, within in (("1g", str(16 << 20)), ("8m", str(8 << 20))):
            spark.conf.set(key, said)
            with pytest.raises(ZeroDivisionError):
                with scan_splits(spark, 16 << 20):
                    assert spark.conf.get(key) == within
                    1 / 0
            assert spark.conf.get(key) == said
    finally:
        spark.conf.set(key, before)


def test_the_dedupe_compares_the_series_before_the_source(spark):
    p = dedupe.dedupe_observations(spark.createDataFrame([], SILVER_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in p.splitlines() if "Sort [" in line]
    assert sorts and all("Sort [indicator_id" in line for line in sorts)

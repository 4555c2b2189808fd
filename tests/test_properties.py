"""Property tests: Spark results against plain-Python brute force."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indtables.functions.dates import period_start
from indtables.operators.long import gold_long


def period_rule(text):
    """The period rule as stated: split at the first '/', month defaults to
    1, both parts whole numbers, year 1..9999, month 1..12."""
    if text is None or text == "":
        return None
    year, sep, month = text.partition("/")
    month = month or "1"
    try:
        y, m = int(year.strip()), int(month.strip())
    except ValueError:
        return None
    if not (1 <= y <= 9999 and 1 <= m <= 12):
        return None
    return dt.date(y, m, 1)


PERIOD_TEXT = st.one_of(
    st.text(alphabet="0123456789/Q -", max_size=9),
    st.builds(lambda y, m: f"{y}/{m}", st.integers(-5, 12000), st.integers(-2, 14)),
    st.builds(lambda y, m: f"{y}/{m:02d}", st.integers(1, 9999), st.integers(0, 13)),
    st.builds(str, st.integers(0, 10001)),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(PERIOD_TEXT, min_size=1, max_size=40))
def test_period_rule_matches_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r["d"] for r in df.select(period_start(F.col("p")).alias("d")).collect()]
    assert got == [period_rule(t) for t in texts]


def brute_long(rows, days=30):
    """rows: (series, date, value) with one row per (series, date)."""
    out = {}
    by_series = {}
    for s, d, v in rows:
        by_series.setdefault(s, []).append((d, v))
    for s, pts in by_series.items():
        pts.sort()
        prev = None
        for d, v in pts:
            change = None if prev is None or prev == 0 else (v - prev) / prev * 100
            window = [w for e, w in pts if d - dt.timedelta(days=days) <= e <= d]
            out[(s, d)] = (change, sum(window) / len(window))
            prev = v
    return out


def test_long_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for s in "abc":
        d = dt.date(2021, 1, 1)
        for _ in range(120):
            d += dt.timedelta(days=rnd.choice([1, 1, 2, 5, 17, 31, 40]))
            rows.append((s, d, float(rnd.choice([0, 0, rnd.randrange(-500, 500)])) / 4))
    df = spark.createDataFrame(
        [("src", s, s, d, v, False) for s, d, v in rows],
        "source string, indicator_id string, indicator_label string, obs_date date, value double, is_fallback boolean",
    )
    want = brute_long(rows)
    for scale in (None, 2):
        got = {(r["indicator_id"], r["obs_date"]): (r["change_pct"], r["rolling_avg_30d"])
               for r in gold_long(df, mean_scale=scale).collect()}
        assert got.keys() == want.keys()
        for k, (c, m) in want.items():
            gc, gm = got[k]
            assert (gc is None) == (c is None), k
            if c is not None:
                assert abs(gc - c) <= 1e-9 * max(1.0, abs(c)), k
            assert abs(gm - m) <= 1e-9 * max(1.0, abs(m)), k


def brute_wide(rows, window):
    """rows: (label, date, value), one per (label, date). Latest value at or
    before each day, for every day of the trimmed calendar."""
    dates = [d for _, d, _ in rows]
    lo, hi = min(dates), max(dates)
    start = lo if window is None else max(lo, hi - dt.timedelta(days=window))
    labels = sorted({l for l, _, _ in rows})
    out = []
    day = start
    while day <= hi:
        vals = []
        for l in labels:
            past = [(d, v) for ll, d, v in rows if ll == l and d <= day]
            vals.append(max(past)[1] if past else None)
        out.append((day, *vals))
        day += dt.timedelta(days=1)
    return labels, out


SERIES = st.dictionaries(
    st.sampled_from(["a", "b", "c"]),
    st.dictionaries(st.integers(0, 120), st.integers(-50, 50), min_size=1, max_size=8),
    min_size=1,
)


@settings(max_examples=12, deadline=None)
@given(SERIES, st.sampled_from([None, 0, 3, 30, 400]))
def test_wide_matches_brute_force(spark, series, window):
    from indtables.operators.wide import gold_wide

    base = dt.date(2024, 1, 1)
    rows = [(l, base + dt.timedelta(days=o), float(v)) for l, pts in series.items() for o, v in pts.items()]
    df = spark.createDataFrame(
        [("s", l, l, d, v, False) for l, d, v in rows],
        "source string, indicator_id string, indicator_label string, obs_date date, value double, is_fallback boolean",
    )
    labels, want = brute_wide(rows, window)
    got = gold_wide(df, window)
    assert got.columns == ["calendar_date", *labels]
    assert sorted(tuple(r) for r in got.collect()) == want


OBS = st.lists(
    st.tuples(
        st.sampled_from(["x", "y"]),          # indicator
        st.integers(0, 3),                    # day offset
        st.integers(-3, 3),                   # value
        st.booleans(),                        # is_fallback
        st.integers(0, 4),                    # pull time (hours)
        st.sampled_from(["f1", "f2", "f3"]),  # pull file
        st.sampled_from(["L", "M"]),          # label
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=15, deadline=None)
@given(OBS)
def test_dedupe_matches_brute_force(spark, obs):
    from indtables.operators.silver import dedupe_observations

    base = dt.datetime(2026, 1, 1)
    rows = [("s", i, lab, dt.date(2026, 1, 1) + dt.timedelta(days=d), float(v), fb,
             base + dt.timedelta(hours=h), f) for i, d, v, fb, h, f, lab in obs]
    df = spark.createDataFrame(rows, "source string, indicator_id string, indicator_label string, obs_date date, "
                                     "value double, is_fallback boolean, _pulled_at timestamp, _pull_file string")
    best = {}
    for r in rows:
        key = (r[0], r[1], r[3])
        # real first, newest pull, then file name, then larger value, then smaller label
        rank = (r[5], -r[6].timestamp(), [-ord(c) for c in r[7]], -r[4], r[2])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    want = sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for _, r in best.values())
    got = sorted(tuple(x) for x in dedupe_observations(df).collect())
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40))
def test_exact_sum_column_and_sql_forms_agree(spark, xs):
    from indtables.functions.values import exact_sum, exact_sum_sql

    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    a = df.agg(exact_sum(F.col("x"), 8).alias("s")).first()["s"]
    b = df.agg(F.expr(exact_sum_sql("x", 8)).alias("s")).first()["s"]
    c = df.repartition(7).agg(exact_sum(F.col("x"), 8).alias("s")).first()["s"]
    assert a == b == c  # and independent of how rows are partitioned


DAY_TEXT = st.one_of(
    st.builds(lambda d, m, y: f"{d}/{m}/{y}", st.integers(0, 33), st.integers(0, 13), st.integers(1999, 2031)),
    st.builds(lambda d, m, y: f"{d:02d}/{m:02d}/{y}", st.integers(0, 33), st.integers(0, 13), st.integers(1999, 2031)),
    st.text(alphabet="0123456789/", max_size=10),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(DAY_TEXT, min_size=1, max_size=40))
def test_day_month_year_matches_python(spark, texts):
    from indtables.functions.dates import day_month_year

    def py(t):
        try:
            return dt.datetime.strptime(t, "%d/%m/%Y").date()
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["d"] for r in df.select(day_month_year(F.col("t")).alias("d")).collect()]
    assert got == [py(t) for t in texts]

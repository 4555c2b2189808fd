"""W2/W3 over time buckets: the long table of one very long series as many tasks,
and of chosen months only.

A row's change needs the series' row before it, its rolling mean the rows of the
``ROLLING_DAYS`` before it. So a bucket of days can be computed on its own if it
is given, beside its own rows,

* the *halo*: the series' rows of the ``ROLLING_DAYS`` days before the bucket, and
* the *carry*: the series' last row before that, however old.

Halo rows are copies of at most ``ROLLING_DAYS`` rows a series and bucket. The
carry comes from the last row of every (series, bucket), a hash aggregate with
map-side combine, and a window over those few. The window then partitions by
(series, bucket): no task holds more of a series than a bucket and its halo, and
the result is that of ``gold_long`` to the bit (a RANGE frame holds the same rows
in the same order)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indtables.functions.values import exact_sum_sql, pct_change
from indtables.operators.long import ROLLING_DAYS, SERIES_KEY
from indtables.schemas import LONG_COLUMNS, SILVER_COLUMNS

EPOCH = dt.date(1970, 1, 1)
BUCKET_DAYS = 3652
# The month of a day as a number, 202403: the partition column of stored tables.
MONTH = "obs_month"
BUCKET, OWN = "_bucket", "_own"


def month_of(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_start(month: int) -> dt.date:
    return dt.date(month // 100, month % 100, 1)


def _long_of_buckets(rows: DataFrame, rolling_days: int, mean_scale: int | None) -> DataFrame:
    """Long rows of the own rows among ``rows`` (silver columns, bucket, own)."""
    keys = [*SERIES_KEY, BUCKET]
    frame = (f"PARTITION BY {', '.join(keys)} ORDER BY obs_date "
             f"RANGE BETWEEN INTERVAL {int(rolling_days)} DAYS PRECEDING AND CURRENT ROW")
    if mean_scale is None:
        mean = F.expr(f"avg(value) OVER ({frame})")
    else:
        mean = F.expr(f"{exact_sum_sql('value', mean_scale, frame)} / count(value) OVER ({frame})")
    before = F.lag("value").over(Window.partitionBy(*keys).orderBy("obs_date"))
    out = rows.select(*SILVER_COLUMNS, OWN, before.alias("_prev"), mean.alias("rolling_avg_30d")).filter(OWN)
    return out.withColumn("change_pct", pct_change(F.col("value"), F.col("_prev"))).select(*LONG_COLUMNS)


def last_rows(rows: DataFrame, bucket: Column) -> DataFrame:
    """(series, bucket, obs_date, value): the last row of each series and bucket."""
    return rows.groupBy(*SERIES_KEY, bucket.alias(BUCKET)).agg(
        F.max("obs_date").alias("obs_date"), F.max_by("value", "obs_date").alias("value")
    )


def carries(lasts: DataFrame) -> DataFrame:
    """Of each (series, bucket) in ``lasts``, the last row of the bucket before."""
    w = Window.partitionBy(*SERIES_KEY).orderBy(BUCKET)
    return lasts.select(
        *SERIES_KEY, BUCKET, F.lag("obs_date").over(w).alias("obs_date"), F.lag("value").over(w).alias("value")
    ).filter("obs_date IS NOT NULL")


def _placed(rows: DataFrame, own: bool) -> DataFrame:
    return rows.select(*SILVER_COLUMNS, F.col(BUCKET).cast("int").alias(BUCKET), F.lit(own).alias(OWN))


def _carried(carry: DataFrame) -> DataFrame:
    """Carry rows as silver rows (their label and flag are never returned)."""
    return _placed(carry.select("*", F.lit("").alias("indicator_label"), F.lit(False).alias("is_fallback")), False)


def gold_long_bucketed(
    silver: DataFrame, bucket_days: int = BUCKET_DAYS, rolling_days: int = ROLLING_DAYS, mean_scale: int | None = None
) -> DataFrame:
    """``gold_long`` with window partitions of ``bucket_days`` days of a series."""
    if bucket_days < rolling_days:
        raise ValueError(f"a bucket must be at least {rolling_days} days")
    day = F.datediff("obs_date", F.lit(EPOCH))
    bucket = F.floor(day / bucket_days).cast("int")
    start = F.date_add(F.lit(EPOCH), F.col(BUCKET) * bucket_days)
    own = silver.withColumn(BUCKET, bucket)
    halo = own.filter(F.pmod(day, F.lit(bucket_days)) >= bucket_days - rolling_days).withColumn(BUCKET, F.col(BUCKET) + 1)
    carry = carries(last_rows(silver, bucket)).filter(F.col("obs_date") < F.date_sub(start, rolling_days))
    rows = _placed(own, True).unionByName(_placed(halo, False)).unionByName(_carried(carry))
    return _long_of_buckets(rows, rolling_days, mean_scale)


# ------------------------------------------------------------ chosen months

def _months_back(months: Iterable[int], days: int) -> list[int]:
    """The months of the ``days`` days before each month."""
    found = set()
    for m in months:
        for back in range(1, days + 1):
            d = month_start(m) - dt.timedelta(days=back)
            found.add(d.year * 100 + d.month)
    return sorted(found)


def reached_months(days: DataFrame, rolling_days: int = ROLLING_DAYS) -> list[int]:
    """The months whose long rows can differ when rows of ``days`` (obs_date, and
    _next: the series' next day or null) do: the days themselves, the rolling
    frames that hold them, and the successor's change."""
    frames = F.sequence(F.trunc("obs_date", "MM"), F.trunc(F.date_add("obs_date", rolling_days), "MM"),
                        F.expr("INTERVAL 1 MONTH"))
    hit = F.array_append(F.transform(frames, month_of), month_of(F.col("_next")))
    found = days.select(F.explode(hit).alias(MONTH)).filter(F.col(MONTH).isNotNull()).distinct()
    return sorted(r[0] for r in found.collect())  # calendar months, not rows


def gold_long_of_months(
    silver: DataFrame, tails: DataFrame, months: list[int], rolling_days: int = ROLLING_DAYS, mean_scale: int | None = None
) -> DataFrame:
    """The long rows of ``months``, from those months of ``silver`` (which holds
    the month column, so that other months' files are not read), the months of the
    halo, the years of the months, and ``tails`` (series, obs_year, obs_date,
    value: each series' last row of every year)."""
    years = sorted({m // 100 for m in months})
    own = silver.filter(F.col(MONTH).isin(months)).withColumn(BUCKET, F.col(MONTH))
    first, last = F.add_months(F.trunc("obs_date", "MM"), 1), F.trunc(F.date_add("obs_date", rolling_days), "MM")
    later = F.when(first <= last, F.transform(F.sequence(first, last, F.expr("INTERVAL 1 MONTH")), month_of))
    halo = silver.filter(F.col(MONTH).isin(_months_back(months, rolling_days)))
    halo = halo.select(*SILVER_COLUMNS, F.explode(later).alias(BUCKET)).filter(F.col(BUCKET).isin(months))
    in_years = silver.filter(F.col(MONTH).isin([y * 100 + m for y in years for m in range(1, 13)]))
    older = tails.filter(~F.col("obs_year").isin(years)).select(
        *SERIES_KEY, (F.col("obs_year") * 100 + 12).cast("int").alias(BUCKET), "obs_date", "value"
    )
    carry = carries(last_rows(in_years, F.col(MONTH)).unionByName(older)).filter(F.col(BUCKET).isin(months))
    start = F.make_date(F.floor(F.col(BUCKET) / 100).cast("int"), F.col(BUCKET) % 100, F.lit(1))
    carry = carry.filter(F.col("obs_date") < F.date_sub(start, rolling_days))
    rows = _placed(own, True).unionByName(_placed(halo, False)).unionByName(_carried(carry))
    return _long_of_buckets(rows, rolling_days, mean_scale)


def tails_of(silver: DataFrame) -> DataFrame:
    """Each series' last row of every year."""
    return last_rows(silver, F.year("obs_date")).withColumnRenamed(BUCKET, "obs_year")

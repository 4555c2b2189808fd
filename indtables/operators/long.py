"""Gold long: silver plus change against the previous observation and a
30-calendar-day rolling mean, per (source, indicator_id).

Both columns share one window ordered by ``obs_date`` (a DATE, so the frame
is zone-free), so the plan has one exchange and one sort, and the output
stays ordered by (source, indicator_id, obs_date): writing it sorted costs
no second sort. The rolling frame is a RANGE over days: rows dated
d-30 .. d inclusive (up to 31 dates). The DataFrame API cannot write an
INTERVAL frame bound, so that one expression is SQL text over the same
partitioning and order.

After the silver dedupe a series has at most one row per day, so a window
partition holds at most the days of that series' history: hot indicators
cannot grow a partition beyond their calendar span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indtables.functions.values import exact_sum_sql, pct_change
from indtables.schemas import LONG_COLUMNS

SERIES_KEY = ["source", "indicator_id"]
ROLLING_DAYS = 30


def series_window():
    return Window.partitionBy(*SERIES_KEY).orderBy("obs_date")


def rolling_frame_sql(rolling_days: int = ROLLING_DAYS) -> str:
    return (
        f"PARTITION BY {', '.join(SERIES_KEY)} ORDER BY obs_date "
        f"RANGE BETWEEN INTERVAL {int(rolling_days)} DAYS PRECEDING AND CURRENT ROW"
    )


def rolling_mean(rolling_days: int = ROLLING_DAYS, mean_scale: int | None = None) -> Column:
    """Mean of ``value`` over the days d-``rolling_days`` .. d of the series."""
    frame = rolling_frame_sql(rolling_days)
    if mean_scale is None:
        return F.expr(f"avg(value) OVER ({frame})")
    return F.expr(f"{exact_sum_sql('value', mean_scale, frame)} / count(value) OVER ({frame})")


def gold_long(silver: DataFrame, rolling_days: int = ROLLING_DAYS, mean_scale: int | None = None) -> DataFrame:
    """``change_pct`` = percent change vs the previous observation (NULL for
    the first one or a zero base); ``rolling_avg_30d`` = mean of the values
    dated within ``rolling_days`` days up to and including this one.

    ``mean_scale``: when set, the mean is an exact fixed-point sum over the
    count (inputs with at most that many decimals give order-free, hence
    engine-independent, results). Default: plain ``avg``."""
    base = [c for c in silver.columns if c in LONG_COLUMNS]
    out = silver.select(
        *base,
        F.lag("value").over(series_window()).alias("_prev"),
        rolling_mean(rolling_days, mean_scale).alias("rolling_avg_30d"),
    )
    out = out.withColumn("change_pct", pct_change(F.col("value"), F.col("_prev")))
    return out.select(*LONG_COLUMNS)

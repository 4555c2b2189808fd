"""The wide table the slow way, to check the library's against: full calendar,
pivot, left join, one unpartitioned running window, then trim."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indtables.functions.names import named
from indtables.operators.wide import (
    RECENT_WINDOW_DAYS,
    bounds,
    calendar,
    calendar_join,
    one_per_label_day,
    pivot_by_day,
    trim_recent,
    wide_labels,
)


def ffill_single_window(joined: DataFrame, labels: list[str]) -> DataFrame:
    w = Window.orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        "calendar_date", *[F.last(named(l), ignorenulls=True).over(w).alias(l) for l in labels]
    )


def gold_wide_by_window(silver: DataFrame, recent_window_days: int | None = RECENT_WINDOW_DAYS) -> DataFrame:
    inp, labels = bounds(silver), wide_labels(silver)
    cal = calendar(silver.sparkSession, inp.min_date, inp.max_date)
    filled = ffill_single_window(calendar_join(cal, pivot_by_day(one_per_label_day(silver), labels)), labels)
    return filled if recent_window_days is None else trim_recent(filled, inp.max_date, recent_window_days)

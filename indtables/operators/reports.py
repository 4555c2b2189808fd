"""The report queries on top of the gold tables.

Each sheet exists in two forms. ``*_spec`` is what the report spec asks for
(values per observation day, latest KPI row, synthetic-data flag).
``*_shipped`` is what the published workbook actually computes: sums by
year or by day-of-month, and KPI tiles that add up the whole column and only
show when the table's last day equals a frozen date.

``sum_scale``: when set, sums run in fixed point with that many decimals
(order-free, so any engine gives the same double); default is a plain SUM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.functions.names import named
from indtables.functions.values import exact_sum

# The labels and source each sheet filters on.
FX_LABEL = "fx_rate_usd_mxn"
INPC_LABEL = "inpc_general"
IGAE_LEVEL_LABEL = "igae_ivf"
IGAE_YOY_LABEL = "igae_variacion_anual"
HEADCOUNT_LABEL = "desocupados_total"
RATE_LABEL = "desempleo_tasa"
EMPLOYMENT_SOURCE = "inegi"
KPI_LABELS = [FX_LABEL, INPC_LABEL, IGAE_LEVEL_LABEL, RATE_LABEL]
# Fixed value: the date the published KPI tiles are frozen on.
KPI_FROZEN_DATE = "2026-08-28"


def _sum(c: Column, scale: int | None) -> Column:
    return F.sum(c) if scale is None else exact_sum(c, scale)


def _label(long: DataFrame, label: str, source: str | None = None) -> DataFrame:
    cond = F.col("indicator_label") == label
    if source is not None:
        cond = cond & (F.col("source") == source)
    return long.filter(cond)


# R1 -------------------------------------------------------------------------

_KEY = ["source", "indicator_id", "obs_date"]


def report_fx_spec(long: DataFrame, label: str = FX_LABEL) -> DataFrame:
    """Per observation: value and 30-day mean of the FX series."""
    return _label(long, label).select(*_KEY, "value", "rolling_avg_30d")


def report_fx_shipped(long: DataFrame, label: str = FX_LABEL, sum_scale: int | None = None) -> DataFrame:
    """As published: sums by day of month (1-31) across all months."""
    return _label(long, label).groupBy(F.dayofmonth("obs_date").alias("day_of_month")).agg(
        _sum(F.col("value"), sum_scale).alias("sum_value"),
        _sum(F.col("rolling_avg_30d"), sum_scale).alias("sum_rolling_avg_30d"),
    )


# R2 -------------------------------------------------------------------------

def report_inpc_spec(long: DataFrame, label: str = INPC_LABEL) -> DataFrame:
    """Per observation: change against the previous observation."""
    return _label(long, label).select(*_KEY, "change_pct")


def report_inpc_shipped(long: DataFrame, label: str = INPC_LABEL, sum_scale: int | None = None) -> DataFrame:
    """As published: the percent changes summed by calendar year (NULL for a
    year with only NULL changes). Not a year-over-year figure."""
    return _label(long, label).groupBy(F.year("obs_date").alias("obs_year")).agg(
        _sum(F.col("change_pct"), sum_scale).alias("sum_change_pct")
    )


# R3 -------------------------------------------------------------------------

def _igae_columns(level: str, yoy: str) -> list[Column]:
    label = F.col("indicator_label")
    return [
        F.when(label == level, F.col("value")).alias("igae_level"),
        F.when(label == yoy, F.col("value")).alias("igae_yoy_pct"),
    ]


def report_igae_spec(long: DataFrame, level: str = IGAE_LEVEL_LABEL, yoy: str = IGAE_YOY_LABEL) -> DataFrame:
    """Two conditional columns (level, year-over-year %) per observation:
    each row fills the column of its own label, the other stays NULL."""
    return long.filter(F.col("indicator_label").isin(level, yoy)).select(*_KEY, *_igae_columns(level, yoy))


def report_igae_shipped(
    long: DataFrame, level: str = IGAE_LEVEL_LABEL, yoy: str = IGAE_YOY_LABEL, sum_scale: int | None = None
) -> DataFrame:
    """As published: both conditional columns summed by year."""
    rows = long.filter(F.col("indicator_label").isin(level, yoy)).select(
        F.year("obs_date").alias("obs_year"), *_igae_columns(level, yoy)
    )
    return rows.groupBy("obs_year").agg(
        _sum(F.col("igae_level"), sum_scale).alias("sum_igae_level"),
        _sum(F.col("igae_yoy_pct"), sum_scale).alias("sum_igae_yoy_pct"),
    )


# R4 / R5 --------------------------------------------------------------------

def report_series_spec(long: DataFrame, label: str, source: str | None = EMPLOYMENT_SOURCE) -> DataFrame:
    """One series' value per observation."""
    return _label(long, label, source).select(*_KEY, "value")


def report_series_shipped(
    long: DataFrame, label: str, source: str | None = EMPLOYMENT_SOURCE, sum_scale: int | None = None
) -> DataFrame:
    """As published: the series' values summed by year."""
    return _label(long, label, source).groupBy(F.year("obs_date").alias("obs_year")).agg(
        _sum(F.col("value"), sum_scale).alias("sum_value")
    )


def report_headcount_spec(long: DataFrame, label: str = HEADCOUNT_LABEL,
                          source: str | None = EMPLOYMENT_SOURCE) -> DataFrame:
    return report_series_spec(long, label, source)


def report_headcount_shipped(long: DataFrame, label: str = HEADCOUNT_LABEL, source: str | None = EMPLOYMENT_SOURCE,
                             sum_scale: int | None = None) -> DataFrame:
    return report_series_shipped(long, label, source, sum_scale)


def report_rate_spec(long: DataFrame, label: str = RATE_LABEL, source: str | None = EMPLOYMENT_SOURCE) -> DataFrame:
    return report_series_spec(long, label, source)


def report_rate_shipped(long: DataFrame, label: str = RATE_LABEL, source: str | None = EMPLOYMENT_SOURCE,
                        sum_scale: int | None = None) -> DataFrame:
    """As published: monthly *rates* summed by year (not a rate any more)."""
    return report_series_shipped(long, label, source, sum_scale)


# R6-R9 ----------------------------------------------------------------------

def kpi_latest(wide: DataFrame, labels: Sequence[str] = KPI_LABELS) -> DataFrame:
    """KPI tiles as specified: each column's value in the latest wide row.
    One hash aggregate (``max_by``), no sort of the table."""
    return wide.agg(
        F.max("calendar_date").alias("calendar_date"),
        *[F.max_by(named(l), "calendar_date").alias(l) for l in labels],
    )


def kpi_shipped(
    wide: DataFrame,
    labels: Sequence[str] = KPI_LABELS,
    frozen_date: str = KPI_FROZEN_DATE,
    sum_scale: int | None = None,
) -> DataFrame:
    """KPI tiles as published: SUM of each column over every row, shown only
    when MAX(calendar_date) is the frozen date (one row, or none)."""
    agg = wide.agg(
        F.max("calendar_date").alias("max_calendar_date"),
        *[_sum(named(l), sum_scale).alias(f"sum_{l}") for l in labels],
    )
    d = F.to_date(F.lit(frozen_date))
    return agg.filter(F.col("max_calendar_date").between(d, d))


# R10 ------------------------------------------------------------------------

def fallback_callout(long: DataFrame) -> DataFrame:
    """Per label: does any row come from synthetic data?"""
    return long.groupBy("indicator_label").agg(F.bool_or("is_fallback").alias("any_fallback"))

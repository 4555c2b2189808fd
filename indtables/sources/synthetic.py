"""Synthetic stand-ins for failed pulls, shaped exactly like real answers so
they go through the same parsers, plus the choice between real and
synthetic rows.

Feed A: a failed pull over [start, end] becomes one document with a daily
series (every day, both ends included) and a month-start series (days whose
day-of-month is 1). Feed B: each registry entry becomes one document with
six monthly periods. The day lists are built inside the row with
``sequence``/``transform`` (no grouping, no driver loop), so a pull's size is
bounded by its own date range.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Synthetic feed A series (id, title, constant value text).
FEED_A_DAILY = ("SF43718", "Tipo de cambio FIX (fallback)", "17.5")
FEED_A_MONTH_START = ("SP1", "INPC general (fallback)", "130.0")
# Synthetic feed B periods and their constant value text.
FEED_B_PERIODS = ["2026/01", "2026/02", "2026/03", "2026/04", "2026/05", "2026/06"]
FEED_B_VALUE = "100.0"
# Feed B indicator registry (id, label, endpoint family).
FEED_B_REGISTRY = [
    ("6200093973", "desocupados_total", "BISE"),
    ("444603", "desempleo_tasa", "BIE-BISE"),
    ("737121", "igae_ivf", "BIE-BISE"),
    ("737145", "igae_variacion_anual", "BIE-BISE"),
]
# Fixed value: depth of a feed A pull, in days before its end date.
PULL_LOOKBACK_DAYS = 400
DAY_MONTH_YEAR = "dd/MM/yyyy"


def pull_start(end: Column, lookback_days: int = PULL_LOOKBACK_DAYS) -> Column:
    """A pull covers ``lookback_days`` days before ``end`` and ``end``."""
    return F.date_sub(end, lookback_days)


def registry_frame(spark: SparkSession) -> DataFrame:
    """The feed B registry as a small DataFrame (indicator_id, label, family)."""
    return spark.createDataFrame(FEED_B_REGISTRY, "indicator_id string, label string, family string")


def _days(start: Column, end: Column) -> Column:
    return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )


def _month_starts(start: Column, end: Column) -> Column:
    first = F.when(F.dayofmonth(start) == 1, start).otherwise(F.trunc(F.add_months(start, 1), "month"))
    return F.when(first <= end, F.sequence(first, end, F.expr("INTERVAL 1 MONTH"))).otherwise(
        F.array().cast("array<date>")
    )


def _series_a(spec: tuple[str, str, str], dates: Column) -> Column:
    sid, title, value = spec
    points = F.transform(
        dates, lambda d: F.struct(F.date_format(d, DAY_MONTH_YEAR).alias("fecha"), F.lit(value).alias("dato"))
    )
    return F.struct(F.lit(sid).alias("idSerie"), F.lit(title).alias("titulo"), points.alias("datos"))


def feed_a_fallback_docs(
    pulls: DataFrame, start: str = "start_date", end: str = "end_date", keep: Iterable[str] = ()
) -> DataFrame:
    """S5 + S6: one synthetic feed A document per pull row (``start``..``end``)."""
    s, e = F.col(start), F.col(end)
    series = F.array(_series_a(FEED_A_DAILY, _days(s, e)), _series_a(FEED_A_MONTH_START, _month_starts(s, e)))
    return pulls.select(
        *keep, F.lit(True).alias("is_fallback"), F.struct(series.alias("series")).alias("bmx")
    )


def feed_b_fallback_docs(
    registry: DataFrame, id_col: str = "indicator_id", label_col: str = "label", keep: Iterable[str] = ()
) -> DataFrame:
    """One synthetic feed B document per registry row."""
    obs = F.array(
        *[F.struct(F.lit(p).alias("TIME_PERIOD"), F.lit(FEED_B_VALUE).alias("OBS_VALUE")) for p in FEED_B_PERIODS]
    )
    series = F.array(F.struct(F.col(id_col).cast("string").alias("INDICADOR"), obs.alias("OBSERVATIONS")))
    return registry.select(
        *keep,
        F.lit(True).alias("is_fallback"),
        F.col(label_col).cast("string").alias("label"),
        series.alias("Series"),
    )


def choose_fallback(real: DataFrame, synthetic: DataFrame, failed: DataFrame, key: str | list[str]) -> DataFrame:
    """A unit (a whole source, or one indicator) is either all real or
    all synthetic. ``failed`` lists the units whose call failed; their real
    rows (if any) are dropped and their synthetic rows taken. A unit that
    answered with nothing stays empty. Both sides are semi/anti joins on the
    key; AQE broadcasts ``failed`` when it measures small."""
    keys = [key] if isinstance(key, str) else list(key)
    failed_keys = failed.select(*keys)
    kept_real = real.join(failed_keys, keys, "left_anti")
    substitutes = synthetic.join(failed_keys, keys, "left_semi")
    return kept_real.unionByName(substitutes)

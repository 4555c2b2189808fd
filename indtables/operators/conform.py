"""Bronze documents to conformed observation rows (feed A, feed B, union).

Both feeds are nested two levels (document -> series -> points). The
unnest is two ``explode`` steps, so a missing or empty array yields no row.
Each parser returns *candidate* rows: the silver columns plus the raw text
and a ``reject_reason`` (NULL for good rows). ``accepted`` and ``rejected``
split them; ``strict=True`` instead fails the job on the first bad row,
the way a plain cast would.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.functions.dates import day_month_year, period_start
from indtables.functions.values import feed_a_missing, feed_b_missing
from indtables.schemas import SILVER_COLUMNS

# Feed A series ids and their labels; unmapped ids keep the id.
FEED_A_LABELS = {"SF43718": "fx_rate_usd_mxn", "SP1": "inpc_general"}
# Source names and the default label of a feed B document.
FEED_A_SOURCE = "banxico"
FEED_B_SOURCE = "inegi"
FEED_B_DEFAULT_LABEL = "unknown"


def label_for(indicator_id: Column, labels: Mapping[str, str] | None) -> Column:
    """Label lookup as a literal map: no join, id itself when unmapped."""
    if not labels:
        return indicator_id
    pairs = []
    for k, v in sorted(labels.items()):
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), indicator_id), indicator_id)


def label_join(rows: DataFrame, labels: DataFrame, id_col: str = "indicator_id", label_col: str = "label") -> DataFrame:
    """Label lookup against a label table (id, label) of any size: a left
    join whose strategy AQE picks from measured sizes. An id listed twice
    takes its smallest label (the join never multiplies rows); unmapped ids
    keep their id as label."""
    lab = labels.groupBy(F.col(id_col).alias("_lab_id")).agg(F.min(label_col).alias("_lab_label"))
    out = rows.join(lab, rows["indicator_id"] == lab["_lab_id"], "left")
    return out.withColumn("indicator_label", F.coalesce("_lab_label", "indicator_id")).drop("_lab_id", "_lab_label")


# A plain decimal number; Spark's cast alone also takes Java's 1.5d and 2f.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _value(raw: Column) -> tuple[Column, Column]:
    """(value, reason): NaN and infinities (also by overflow) are rejects, they
    would spoil every mean that covers them."""
    v = raw.try_cast("double")
    inf = F.lit(float("inf"))
    bad = (
        F.when(F.isnan(v), F.lit("not_a_number"))
        .when((v == inf) | (v == -inf), F.lit("not_finite"))
        .when(v.isNull() | ~raw.rlike(NUMBER), F.lit("bad_value"))
    )
    return F.when(bad.isNull(), v), bad


def _finish(df: DataFrame, strict: bool, carry: list[str]) -> DataFrame:
    cols = SILVER_COLUMNS + ["raw_date", "raw_value", "reject_reason"] + carry
    df = df.select(*cols)
    if strict:
        # The reason column itself raises: any filter on it (as ``accepted``
        # does) fails the job at the first bad row.
        msg = F.concat_ws(
            " ", F.lit("rejected observation:"), F.col("reject_reason"), F.col("source"),
            F.col("indicator_id"), F.col("raw_date"), F.col("raw_value"),
        )
        guard = F.when(F.col("reject_reason").isNotNull(), F.raise_error(msg)).cast("string")
        df = df.withColumn("reject_reason", guard)
    return df


def parse_feed_a(
    docs: DataFrame,
    labels: Mapping[str, str] | None = None,
    source: str = FEED_A_SOURCE,
    strict: bool = False,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Feed A documents (schema ``FEED_A_SCHEMA``) to candidate rows.

    Missing values (NULL, ``""``, ``N/E``) are dropped; absent ``is_fallback``
    is false, absent ``idSerie`` is ``""``; labels come from ``labels``
    (default: the feed's own map). ``carry`` names top-level columns to keep
    (e.g. pull time, file name)."""
    carry = list(carry)
    labels = FEED_A_LABELS if labels is None else labels
    series = docs.select(
        F.coalesce(F.col("is_fallback"), F.lit(False)).alias("is_fallback"),
        *carry,
        F.explode("bmx.series").alias("s"),
    )
    points = series.select(
        "is_fallback",
        *carry,
        F.coalesce(F.col("s.idSerie"), F.lit("")).alias("indicator_id"),
        F.explode("s.datos").alias("p"),
    )
    points = points.select(
        "is_fallback", "indicator_id", *carry,
        F.col("p.fecha").alias("raw_date"), F.col("p.dato").alias("raw_value"),
    ).filter(~feed_a_missing(F.col("raw_value")))
    value, bad_value = _value(F.col("raw_value"))
    obs_date = day_month_year(F.col("raw_date"))
    out = points.select(
        F.lit(source).alias("source"),
        "indicator_id",
        label_for(F.col("indicator_id"), labels).alias("indicator_label"),
        obs_date.alias("obs_date"),
        value.alias("value"),
        "is_fallback",
        "raw_date",
        "raw_value",
        F.coalesce(F.when(obs_date.isNull(), F.lit("bad_date")), bad_value).alias("reject_reason"),
        *carry,
    )
    return _finish(out, strict, carry)


def parse_feed_b(
    docs: DataFrame,
    source: str = FEED_B_SOURCE,
    strict: bool = False,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Feed B documents (schema ``FEED_B_SCHEMA``) to candidate rows.

    The label comes from the document root (absent: ``unknown``). Missing
    value or period drops the point; a malformed period or number is a
    reject, never a silent drop."""
    carry = list(carry)
    series = docs.select(
        F.coalesce(F.col("is_fallback"), F.lit(False)).alias("is_fallback"),
        F.coalesce(F.col("label"), F.lit(FEED_B_DEFAULT_LABEL)).alias("indicator_label"),
        *carry,
        F.explode("Series").alias("s"),
    )
    points = series.select(
        "is_fallback",
        "indicator_label",
        *carry,
        F.coalesce(F.col("s.INDICADOR"), F.lit("")).alias("indicator_id"),
        F.explode("s.OBSERVATIONS").alias("o"),
    )
    points = points.select(
        "is_fallback", "indicator_label", "indicator_id", *carry,
        F.col("o.TIME_PERIOD").alias("raw_date"), F.col("o.OBS_VALUE").alias("raw_value"),
    ).filter(~feed_b_missing(F.col("raw_value"), F.col("raw_date")))
    value, bad_value = _value(F.col("raw_value"))
    obs_date = period_start(F.col("raw_date"))
    out = points.select(
        F.lit(source).alias("source"),
        "indicator_id",
        "indicator_label",
        obs_date.alias("obs_date"),
        value.alias("value"),
        "is_fallback",
        "raw_date",
        "raw_value",
        F.coalesce(F.when(obs_date.isNull(), F.lit("bad_period")), bad_value).alias("reject_reason"),
        *carry,
    )
    return _finish(out, strict, carry)


def accepted(candidates: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Good candidate rows as conformed observations (silver columns)."""
    return candidates.filter(F.col("reject_reason").isNull()).select(*SILVER_COLUMNS, *carry)


def rejected(candidates: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Bad candidate rows with the raw text and the reason, plus ``carry``
    (e.g. the pull lineage, to find the bad pull)."""
    return candidates.filter(F.col("reject_reason").isNotNull()).select(
        "source",
        "indicator_id",
        "raw_date",
        "raw_value",
        F.col("reject_reason").alias("reason"),
        *carry,
    )


def union_feeds(*frames: DataFrame) -> DataFrame:
    """UNION ALL of conformed rows from any number of feeds or pulls."""
    if not frames:
        raise ValueError("union_feeds needs at least one frame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

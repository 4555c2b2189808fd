"""As-of lookup for any probe rows, not just the days of a calendar.

Each probe (a series and a time) takes the latest observation of its series at or
before its time. Probes and observations are one set of rows, split by ranges of
(series, time, a hash of the row), so a series, or a single moment, with a third of
all rows is simply several splits. Within a split a window carries the last value
forward; across splits, every (series, split) reports its last observation (a hash
aggregate with map-side combine), and a window over those few gives each split the
value it starts from. Nothing is expanded: the work follows the rows of both sides,
whatever the gaps between times.

The range split depends on a sample, so the split rows are written once to the
shared scratch folder and both steps read the same splits."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indtables.session import ensure_checkpoint_dir

SPLIT = "_split"


def _side(rows: DataFrame, series: Sequence[Column], time: Column, kind: int, value: Column, row: Column, salt: Column):
    keys = [c.alias(f"_s{i}") for i, c in enumerate(series)]
    return rows.select(*keys, time.alias("_time"), F.lit(kind).alias("_kind"), value.alias("_value"), row.alias("_row"),
                       salt.alias("_salt"))


def split_rows(rows: DataFrame, keys: list[str], splits: int | None) -> DataFrame:
    """``rows`` in ranges of series and time, with the number of their range, written."""
    order = [*keys, "_time", "_kind", "_salt"]
    dealt = rows.repartitionByRange(*([splits] if splits else []), *order).withColumn(SPLIT, F.spark_partition_id())
    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/asof/{uuid.uuid4().hex}"
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def asof_lookup(
    probes: DataFrame,
    observations: DataFrame,
    probe_series: Sequence[str],
    probe_time: str,
    series: Sequence[str] = ("source", "indicator_id"),
    time: str = "obs_date",
    value: str = "value",
    found: tuple[str, str] = ("asof_date", "asof_value"),
    splits: int | None = None,
) -> DataFrame:
    """``probes`` with two more columns, the time and the value found; null where
    the series has no observation by then (or the probe's series or time is null).

    ``found`` must not be columns of ``probes``. Observations with a null series,
    time or value are not there; of several at one time the largest value counts.
    ``splits``: into how many ranges (default: the session's shuffle partitions)."""
    clash = set(found) & set(probes.columns)
    if clash:
        raise ValueError(f"probes already have columns {sorted(clash)}")
    keys = [f"_s{i}" for i in range(len(series))]
    whole = F.struct(*[F.col(f"`{c}`") for c in probes.columns])
    kind = probes.select(whole.alias("row")).schema["row"].dataType
    obs = observations.filter(F.col(f"`{value}`").isNotNull())
    for c in [*series, time]:
        obs = obs.filter(F.col(f"`{c}`").isNotNull())
    right = _side(obs, [F.col(f"`{c}`") for c in series], F.col(f"`{time}`"), 0,
                  F.struct(F.col(f"`{time}`").alias("t"), F.col(f"`{value}`").alias("v")), F.lit(None).cast(kind),
                  F.lit(0).cast("long"))
    known = F.lit(True)
    for c in [*probe_series, probe_time]:
        known = known & F.col(f"`{c}`").isNotNull()
    nothing = F.lit(None).cast(right.schema["_value"].dataType)
    left = _side(probes.filter(known), [F.col(f"`{c}`") for c in probe_series], F.col(f"`{probe_time}`"), 1, nothing,
                 whole, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in probes.columns]))
    rows = split_rows(right.unionByName(left), keys, splits)

    # what each split of a series starts from
    lasts = rows.groupBy(*keys, SPLIT).agg(F.max("_value").alias("_value"), F.max("_kind").alias("_probes"))
    before = Window.partitionBy(*keys).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    start = lasts.select(*keys, SPLIT, "_probes", F.max("_value").over(before).alias("_value"))
    start = start.filter("_probes = 1 AND _value IS NOT NULL").select(
        *keys, F.lit(None).cast(rows.schema["_time"].dataType).alias("_time"), F.lit(-1).alias("_kind"), "_value",
        F.lit(None).cast(kind).alias("_row"), F.lit(0).cast("long").alias("_salt"), SPLIT
    )
    w = Window.partitionBy(*keys, SPLIT).orderBy(F.col("_time").asc_nulls_first(), "_kind", "_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    filled = rows.unionByName(start).select("_kind", "_row", F.last("_value", ignorenulls=True).over(w).alias("_at"))
    out = filled.filter("_kind = 1").select(
        "_row.*", F.col("_at.t").alias(found[0]), F.col("_at.v").alias(found[1])
    )
    rest = probes.filter(~known).select(
        "*", F.lit(None).cast(out.schema[found[0]].dataType).alias(found[0]),
        F.lit(None).cast(out.schema[found[1]].dataType).alias(found[1])
    )
    return out.unionByName(rest)

"""Gold wide: one row per calendar day, one forward-filled column per
indicator label, kept to a recent window; and the tall table it is turned
from, one row per (day, label).

A day's cell holds the latest value of that label observed on or before the
day (an as-of lookup); days before a label's first observation stay NULL.
The window runs from ``max(obs_date) - recent_window_days`` to the latest
observed date, both ends included, and never before the first observation.

Parallel plan, instead of one unpartitioned window over the whole history:

1. one small aggregate job: date bounds, and whether any label is fed by more
   than one series (one row);
2. history before the window collapses, per label, to its last value
   (``max_by``: a hash aggregate with map-side partial combine), placed on
   the cutoff day as the seed;
3. seed + in-window rows get ``valid_to = next obs_date - 1`` (``lead`` per
   label, at most window+2 rows each); each row expands to the days it
   stays current with ``explode(sequence(...))``: the tall table
   (``dense_daily``), of any number of labels;
4. for the wide table, the labels become columns (``wide_columns``) and the
   narrow rows are shuffled by day before the pivot, so what moves does not
   depend on the number of tasks. Over ``PIVOT_GROUP`` labels a day's rows are
   put in their columns' places by an Arrow function, so that the driver's plan
   holds the columns' names once and no expression per label.

Only hash exchanges on label or day; old history is never expanded. The wide
table's label list is on the driver because its columns are; series counts
that make no sensible columns use the tall table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from indtables.functions.names import unique_names

RECENT_WINDOW_DAYS = 400
# Labels pivoted by one aggregate; more are put in place day by day.
PIVOT_GROUP = 1000
# Cells of the wide table that a task holds at once.
CELLS_AT_ONCE = 1 << 20
LABEL = "indicator_label"
DAY = "calendar_date"


@dataclass(frozen=True)
class WideBounds:
    min_date: dt.date | None
    max_date: dt.date | None
    shared_labels: bool  # some label is fed by more than one (source, indicator_id)


def distinct_labels(silver: DataFrame) -> DataFrame:
    """A1: distinct labels (sorted by the caller when fixed as columns)."""
    return silver.select(LABEL).distinct()


def date_bounds(silver: DataFrame) -> DataFrame:
    """A2: global first and last observation date, one row."""
    return silver.agg(F.min("obs_date").alias("min_date"), F.max("obs_date").alias("max_date"))


def bounds(silver: DataFrame) -> WideBounds:
    """Date bounds and label sharing, one row to the driver."""
    series = F.struct("source", "indicator_id")
    per_label = silver.groupBy(LABEL).agg(
        F.min("obs_date").alias("low"), F.max("obs_date").alias("high"),
        (F.min(series) != F.max(series)).alias("shared"),
    )
    row = per_label.agg(F.min("low"), F.max("high"), F.max("shared")).first()
    return WideBounds(row[0], row[1], bool(row[2]))


def wide_labels(silver: DataFrame) -> list[str]:
    """The labels in column order. They are the wide table's columns, so this
    list is the one thing that has to reach the driver."""
    return sorted(r[0] for r in distinct_labels(silver).collect())


def wide_columns(labels: list[str]) -> dict[str, str]:
    """Label -> column name. Names are unique without regard to case and never
    the day's; a label is its own column where it can be (see ``unique_names``)."""
    return dict(zip(labels, unique_names(labels, taken=(DAY,))))


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """G1: every day from ``start`` to ``end`` inclusive, as ``calendar_date``.
    Generated by ``range`` so the rows are spread over partitions."""
    n = (end - start).days + 1
    return spark.range(max(n, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("calendar_date")
    )


def one_per_label_day(silver: DataFrame) -> DataFrame:
    """One value per (label, day). When several series share a label the
    lowest (source, indicator_id) wins."""
    w = Window.partitionBy(LABEL, "obs_date").orderBy("source", "indicator_id")
    return (
        silver.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(LABEL, "obs_date", "value")
    )


def pivot_by_day(obs: DataFrame, labels: list[str], day_col: str = "obs_date") -> DataFrame:
    """A3: group by day, one column per label (``labels`` fixes the columns,
    so no extra distinct job runs)."""
    return obs.groupBy(day_col).pivot(LABEL, labels).agg(F.first("value"))


def calendar_join(cal: DataFrame, pivoted: DataFrame) -> DataFrame:
    """Calendar LEFT JOIN pivoted observations on the day; right key dropped."""
    return cal.join(pivoted, cal["calendar_date"] == pivoted["obs_date"], "left").drop("obs_date")


def window_start(first: dt.date, last: dt.date, recent_window_days: int | None) -> dt.date:
    """First day of the window over observations of ``first`` .. ``last``."""
    if recent_window_days is None:
        return first
    return max(first, last - dt.timedelta(days=recent_window_days))


def window_cutoff(inputs: WideBounds, recent_window_days: int | None) -> dt.date:
    return window_start(inputs.min_date, inputs.max_date, recent_window_days)


def trim_recent(wide: DataFrame, max_date: dt.date, recent_window_days: int) -> DataFrame:
    """Keep ``calendar_date >= max_date - recent_window_days`` (inclusive)."""
    return wide.filter(F.col("calendar_date") >= F.date_sub(F.lit(max_date), recent_window_days))


def _label_day_obs(silver: DataFrame, inputs: WideBounds) -> DataFrame:
    if inputs.shared_labels:
        return one_per_label_day(silver)
    return silver.select(LABEL, "obs_date", "value")


def dense_daily(
    silver: DataFrame, recent_window_days: int | None = RECENT_WINDOW_DAYS, inputs: WideBounds | None = None
) -> DataFrame:
    """The tall table (calendar_date, indicator_label, value): every day of
    the window from a label's first value on, filled forward. ``None`` as the
    window keeps the whole history."""
    inputs = inputs or bounds(silver)
    if inputs.max_date is None:
        return silver.sparkSession.createDataFrame([], f"{DAY} date, {LABEL} string, value double")
    cutoff = window_cutoff(inputs, recent_window_days)
    obs = _label_day_obs(silver, inputs)

    recent = obs.filter(F.col("obs_date") >= F.lit(cutoff))
    seed = obs.filter(F.col("obs_date") < F.lit(cutoff)).groupBy(LABEL).agg(F.max_by("value", "obs_date").alias("value"))
    return dense_from(recent, seed, cutoff, inputs.max_date)


def dense_from(recent: DataFrame, seed: DataFrame, cutoff: dt.date, last: dt.date) -> DataFrame:
    """The tall table of ``cutoff`` .. ``last`` from the window's rows (label, day,
    value; one per label and day) and each label's last value before (label, value)."""
    seed = seed.select(LABEL, F.lit(cutoff).alias("obs_date"), "value", F.lit(-1).alias("_seed"))
    spans = recent.withColumn("_seed", F.lit(0)).unionByName(seed)
    w = Window.partitionBy(LABEL).orderBy("obs_date", "_seed")
    valid_to = F.coalesce(F.date_sub(F.lead("obs_date").over(w), 1), F.lit(last))
    spans = spans.withColumn("_to", valid_to).filter(F.col("_to") >= F.col("obs_date"))
    return spans.select(F.explode(F.sequence("obs_date", "_to", F.expr("INTERVAL 1 DAY"))).alias(DAY), LABEL, "value")


def _pivot(dense: DataFrame, labels: list[str], columns: dict[str, str]) -> DataFrame:
    narrow = dense.repartition(DAY)
    return narrow.groupBy(DAY).pivot(LABEL, labels).agg(F.first("value")).toDF(DAY, *[columns[x] for x in labels])


def _day_rows(dense: DataFrame, labels: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per day of ``dense``, its values put in their columns' places: the
    plan has no expression per label, and a task holds a few days' rows."""
    import numpy as np
    import pyarrow as pa

    place = {label: i for i, label in enumerate(labels)}
    value = dense.schema["value"].dataType
    fields = [StructField(DAY, DateType()), *(StructField(columns[x], value) for x in labels)]
    names, at_once = [f.name for f in fields], max(1, CELLS_AT_ONCE // len(fields))

    def fn(batches):
        days, last, cells, known = [], None, None, np.zeros((len(place), at_once), bool)

        def out():
            n, parts = len(days), [pa.array(days, pa.int32()).cast(pa.date32())]
            parts += [pa.array(c[:n], kind, mask=~k[:n]) for c, k in zip(cells, known)]
            days.clear()
            known[:] = False
            return pa.record_batch(parts, names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            if cells is None:
                kind = batch.column("value").type
                cells = np.zeros((len(place), at_once), kind.to_pandas_dtype())
            day = batch.column(DAY).cast(pa.int32()).to_numpy()
            at = np.array([place.get(x, -1) for x in batch.column(LABEL).to_pylist()], np.int64)
            has = batch.column("value").is_valid().to_numpy(zero_copy_only=False) & (at >= 0)
            value = batch.column("value").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(day[1:] != day[:-1]) + 1).tolist(), len(day)]
            for a, b in zip(cuts, cuts[1:]):
                if day[a] != last:
                    if len(days) == at_once:
                        yield out()
                    last = day[a]
                    days.append(int(last))
                own = a + np.flatnonzero(has[a:b])
                cells[at[own], len(days) - 1] = value[own]
                known[at[own], len(days) - 1] = True
        if days:
            yield out()

    rows = dense.select(DAY, LABEL, "value").repartition(DAY).sortWithinPartitions(DAY)
    return rows.mapInArrow(fn, StructType(fields))


def pivot_dense(dense: DataFrame, labels: list[str], first: dt.date, last: dt.date, group: int = PIVOT_GROUP) -> DataFrame:
    """Tall to wide, one column per label of ``labels``, days ``first``..``last``."""
    columns = wide_columns(labels)
    if len(labels) <= group:
        return _pivot(dense, labels, columns)
    days = calendar(dense.sparkSession, first, last).select(
        DAY, F.lit(None).cast("string").alias(LABEL), F.lit(None).cast(dense.schema["value"].dataType).alias("value")
    )
    return _day_rows(dense.unionByName(days), labels, columns)


def tall_rows(wide: DataFrame) -> DataFrame:
    """The wide table turned back: (calendar_date, indicator_label, value) for every
    day and column, nulls too. A day's values travel as one array, as an Arrow
    vector per column would take its least size for each of them."""
    import numpy as np
    import pyarrow as pa

    columns = [f for f in wide.schema.fields if f.name != DAY]
    names = [f.name for f in columns]
    value = columns[0].dataType if columns else DoubleType()
    schema = StructType([StructField(DAY, DateType()), StructField(LABEL, StringType()), StructField("value", value)])
    if not columns:
        return wide.sparkSession.createDataFrame([], schema)

    def fn(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                day, values = batch.column(0).slice(i, 1), batch.column(1).slice(i, 1).flatten()
                days = day.take(pa.array(np.zeros(len(names), np.int64)))
                yield pa.record_batch([days, pa.array(names), values], names=[DAY, LABEL, "value"])

    return wide.select(DAY, F.expr(f"array(* EXCEPT ({DAY}))").alias("cells")).mapInArrow(fn, schema)


def gold_wide(
    silver: DataFrame,
    recent_window_days: int | None = RECENT_WINDOW_DAYS,
    inputs: WideBounds | None = None,
    labels: list[str] | None = None,
    group: int = PIVOT_GROUP,
) -> DataFrame:
    """Wide table by interval expansion (see module doc). ``None`` as the
    window keeps the whole history."""
    inputs = inputs or bounds(silver)
    if inputs.max_date is None:
        return silver.sparkSession.createDataFrame([], f"{DAY} date")
    labels = wide_labels(silver) if labels is None else labels
    dense = dense_daily(silver, recent_window_days, inputs)
    return pivot_dense(dense, labels, window_cutoff(inputs, recent_window_days), inputs.max_date, group)

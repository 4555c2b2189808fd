"""Incremental refresh: only new pulls are parsed, only touched months are rebuilt.

Silver (with its pull lineage) and long are stored by month of the observation.
A run

1. lands the new pulls (a file stream) and takes the months their good rows are
   in: T;
2. merges silver in T only (the dedupe picks a maximum under a total order, so
   ``dedupe(previous + new) == dedupe(all)``) and lists the rows that changed;
3. rebuilds long in the months those changes reach (``reached_months``: the rolling
   frames that hold a changed day, and the row after it), each month from its own
   rows, 30 days before it and the series' last row before that
   (``gold_long_of_months``); all other months stay as they are written;
4. rebuilds wide, which is a window of days, from that window's months of silver
   and a carried state: the last row of every label before the window;
5. replaces the pointer (``sinks.publish``), which also holds the merged pulls,
   counts and bounds.

Two release folders, a and b, take turns. A run brings the one that is not
published up to date, by dynamic partition overwrite: the months above, and those
in which it lags behind the published one, which are copied. It reads the
published folder and its own finished tables, never a folder it is overwriting, so
a run that dies anywhere leaves readers their release and the next run its input.
Before it writes, the pointer is told which months will be touched; a half-written
folder is thus known to lag there.

Exact exceptions: a changed row that takes another label, or another window
length, makes the state invalid; it is then recomputed from all of silver."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType, TimestampType

from indtables.operators import silver as dedupe
from indtables.operators.buckets import MONTH, gold_long_of_months, month_of, reached_months, tails_of
from indtables.operators.long import SERIES_KEY, gold_long, series_window
from indtables.operators.silver import PULL_FILE, PULL_STAMP, PULLED_AT, SILVER_KEY, dedupe_observations, enforce_not_null
from indtables.operators.wide import (
    LABEL,
    dense_from,
    one_per_label_day,
    pivot_dense,
    window_start,
    wide_labels,
)
from indtables.schemas import LONG_COLUMNS, LONG_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA, with_field
from indtables.session import scan_splits
from indtables.sinks.publish import Release, publish
from indtables.sinks.writers import write_counted, write_parquet, write_partitions

LINEAGE = [PULL_STAMP, PULLED_AT, PULL_FILE]
SLOTS = ("a", "b")
SORTED = [MONTH, *SERIES_KEY, "obs_date"]

_LINEAGE_SCHEMA = with_field(
    with_field(with_field(SILVER_SCHEMA, PULL_STAMP, StringType()), PULLED_AT, TimestampType()), PULL_FILE, StringType()
)
STORED_SILVER = with_field(_LINEAGE_SCHEMA, MONTH, IntegerType())
STORED_LONG = with_field(LONG_SCHEMA, MONTH, IntegerType())
STORED_TAILS = "source string, indicator_id string, obs_date date, value double, obs_year int"
SEEDS = "indicator_label string, obs_date date, source string, indicator_id string, value double"


def stored(spark: SparkSession, release: Release, table: str, schema: StructType | str) -> DataFrame:
    """A table of a slot; the schema is given, as a table without rows has no files."""
    return spark.read.schema(schema).parquet(release.path(table))


@dataclass
class Slots:
    """The published release (None at first), the one to write, and where that one
    lags behind: months of silver and long, years of tails; None for "everywhere"."""

    old: Release | None
    new: Release
    behind: dict[str, list[int]] | None

    @classmethod
    def of(cls, root: str, old: Release | None) -> "Slots":
        name = SLOTS[1] if old is not None and old.name == SLOTS[0] else SLOTS[0]
        behind = old.info.get("behind") if old is not None else None
        return cls(old, Release(root.rstrip("/"), name), behind)


def _months(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(MONTH).distinct().collect())  # calendar months, not rows


def _merge_silver(spark: SparkSession, slots: Slots, new: DataFrame, months: list[int], total_order: bool) -> int:
    """Silver of the new slot; returns the rows written."""
    if slots.old is None:
        rows, copied = new, None
    else:
        before = stored(spark, slots.old, "silver", STORED_SILVER)
        rows = new.unionByName(before.filter(F.col(MONTH).isin(months)))
        if slots.behind is None:
            copied = before.filter(~F.col(MONTH).isin(months))
        else:
            copied = before.filter(F.col(MONTH).isin([m for m in slots.behind["silver"] if m not in months]))
    merged = dedupe_observations(rows, carry=LINEAGE).withColumn(MONTH, month_of(F.col("obs_date")))
    if copied is not None:
        merged = merged.unionByName(copied)
    with scan_splits(spark, dedupe.DEDUPE_SPLIT):
        return write_partitions(enforce_not_null(merged), slots.new.path("silver"), [MONTH], SORTED,
                                whole=slots.behind is None, total=total_order)


def _write_tails(spark: SparkSession, slots: Slots, years: list[int] | None) -> None:
    """Tails of the new slot; ``years`` None: all."""
    silver = stored(spark, slots.new, "silver", STORED_SILVER)
    if years is not None:
        silver = silver.filter(F.col(MONTH).isin([y * 100 + m for y in years for m in range(1, 13)]))
    if years is None or years:
        write_partitions(tails_of(silver), slots.new.path("tails"), ["obs_year"], ["obs_year", *SERIES_KEY],
                         whole=years is None)


def changes(spark: SparkSession, old: Release, new: Release, months: list[int]) -> DataFrame:
    """Rows of ``months`` whose value, label or flag differs between two releases
    (rows are never taken away); ``_was`` is the label before, null for a new row."""
    some = F.col(MONTH).isin(months)
    after = stored(spark, new, "silver", STORED_SILVER).filter(some).select(*SILVER_COLUMNS, MONTH)
    before = stored(spark, old, "silver", STORED_SILVER).filter(some).select(
        *SILVER_KEY, F.col(LABEL).alias("_was"), F.col("value").alias("_value"), F.col("is_fallback").alias("_flag")
    )
    differs = F.col("_was").isNull() | (F.col("value") != F.col("_value")) | (F.col("is_fallback") != F.col("_flag"))
    return after.join(before, SILVER_KEY, "left").filter(differs | (F.col(LABEL) != F.col("_was"))).drop("_value", "_flag")


def _reached(spark: SparkSession, slots: Slots, changed: DataFrame, first: int) -> list[int]:
    """Months whose long rows the changes reach. Reads, from the first changed
    month on, the days of the series that changed."""
    days = stored(spark, slots.new, "silver", STORED_SILVER).filter(F.col(MONTH) >= first).select(*SILVER_KEY)
    own = days.join(changed.select(*SERIES_KEY).distinct(), SERIES_KEY, "left_semi")
    after = own.withColumn("_next", F.lead("obs_date").over(series_window()))
    return reached_months(after.join(changed.select(*SILVER_KEY), SILVER_KEY).select("obs_date", "_next"))


def _write_long(spark: SparkSession, slots: Slots, months: list[int] | None, total_order: bool) -> None:
    """Long of the new slot: ``months`` rebuilt (None: all), the others copied."""
    silver = stored(spark, slots.new, "silver", STORED_SILVER)
    path = slots.new.path("indicators_long")
    if months is None:
        rows = gold_long(silver).withColumn(MONTH, month_of(F.col("obs_date")))
        write_partitions(rows, path, [MONTH], SORTED, whole=True, total=total_order)
        return
    tails = stored(spark, slots.new, "tails", STORED_TAILS)
    rows = gold_long_of_months(silver, tails, months).withColumn(MONTH, month_of(F.col("obs_date")))
    rest = stored(spark, slots.old, "indicators_long", STORED_LONG)
    if slots.behind is None:
        rest = rest.filter(~F.col(MONTH).isin(months))
    else:
        late = [m for m in slots.behind["long"] if m not in months]
        if not months and not late:
            return
        rest = rest.filter(F.col(MONTH).isin(late))
    write_partitions(rows.unionByName(rest), path, [MONTH], SORTED, whole=slots.behind is None, total=total_order)


def _last_per_label(rows: DataFrame) -> DataFrame:
    """A label's latest row, on one day the lowest series (decision D6)."""
    w = Window.partitionBy(LABEL).orderBy(F.col("obs_date").desc(), *SERIES_KEY)
    one = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return one.select(LABEL, "obs_date", *SERIES_KEY, "value")


def seeds_before(silver: DataFrame, cutoff: dt.date, state: DataFrame | None = None, since: dt.date | None = None,
                 months: list[int] | None = None) -> DataFrame:
    """The last row of every label before ``cutoff``. With a ``state`` (that of an
    earlier cutoff, ``since``): from it, the days between the two and the ``months``
    that changed, instead of all of silver."""
    older = silver.filter(F.col("obs_date") < F.lit(cutoff))
    if state is None:
        return _last_per_label(older)
    left = (F.col("obs_date") >= F.lit(since)) & (F.col(MONTH) >= since.year * 100 + since.month)
    moved = older.filter(left | F.col(MONTH).isin(months))
    stay = state.filter((F.col("obs_date") < F.lit(cutoff)) & ~month_of(F.col("obs_date")).isin(months))
    cols = [LABEL, "obs_date", *SERIES_KEY, "value"]
    return _last_per_label(moved.select(*cols).unionByName(stay.select(*cols)))


def wide_of_window(silver: DataFrame, seeds: DataFrame, cutoff: dt.date, last: dt.date) -> DataFrame:
    """The wide table from the window's months of ``silver`` and the ``seeds``."""
    inside = silver.filter((F.col(MONTH) >= cutoff.year * 100 + cutoff.month) & (F.col("obs_date") >= F.lit(cutoff)))
    recent = one_per_label_day(inside)
    labels = wide_labels(recent.select(LABEL).unionByName(seeds.select(LABEL)))
    dense = dense_from(recent, seeds.select(LABEL, "value"), cutoff, last)
    return pivot_dense(dense, labels, cutoff, last)


def _write_wide(spark: SparkSession, slots: Slots, info: dict, months: list[int], relabelled: bool,
                window: int | None, total_order: bool) -> int:
    silver = stored(spark, slots.new, "silver", STORED_SILVER)
    if info["max_date"] is None:
        write_parquet(spark.createDataFrame([], SEEDS), slots.new.path("wide_state"))
        return write_counted(spark.createDataFrame([], "calendar_date date"), slots.new.path("indicators_wide"))
    low, last = (dt.date.fromisoformat(info[k]) for k in ("min_date", "max_date"))
    cutoff = window_start(low, last, window)
    state = since = None
    known = slots.old.info if slots.old is not None else {}
    if known.get("cutoff") and known["window"] == window and not relabelled:
        state, since = stored(spark, slots.old, "wide_state", SEEDS), dt.date.fromisoformat(known["cutoff"])
    write_parquet(seeds_before(silver, cutoff, state, since, months), slots.new.path("wide_state"))
    seeds = stored(spark, slots.new, "wide_state", SEEDS)
    info["cutoff"] = cutoff.isoformat()
    return write_counted(wide_of_window(silver, seeds, cutoff, last), slots.new.path("indicators_wide"),
                         ["calendar_date"], total_order)


def _copy_wide(spark: SparkSession, slots: Slots, info: dict) -> int:
    write_parquet(stored(spark, slots.old, "wide_state", SEEDS), slots.new.path("wide_state"))
    info["cutoff"] = slots.old.info.get("cutoff")
    wide = spark.read.parquet(slots.old.path("indicators_wide"))
    return write_counted(wide, slots.new.path("indicators_wide"), ["calendar_date"])


class _Intent:
    """Tells the pointer where the new slot will be half done, should the run die."""

    def __init__(self, spark: SparkSession, slots: Slots, old: Release | None, pointer: dict | None):
        self.spark, self.old, self.pointer = spark, old, pointer
        self.behind = None if slots.behind is None else dict(slots.behind)

    def add(self, **places: list[int]) -> None:
        if self.behind is None:  # the whole slot is to be written, or there is none yet
            return
        self.behind = self.behind | {k: sorted({*self.behind[k], *v}) for k, v in places.items()}
        info = {k: v for k, v in self.pointer.items() if k != "release"} | {"behind": self.behind}
        self.pointer = publish(self.spark, self.old, info, self.pointer).info


def merge_pulls(spark: SparkSession, root: str, old: Release | None, new: DataFrame, merged_through: int,
                window: int | None, total_order: bool = False) -> Release:
    """Publish the release that holds ``old`` and the good rows of ``new`` pulls
    (silver columns and lineage)."""
    start = None if old is None else old.info
    new = new.withColumn(MONTH, month_of(F.col("obs_date")))
    months = _months(new)
    said = {"mode": "incremental", "merged_through": merged_through, "window": window}
    if old is not None and not months and old.info["window"] == window:
        kept = {k: v for k, v in old.info.items() if k != "release"}
        return publish(spark, Release(old.root, old.name), kept | said, start)  # nothing but, at most, rejects
    slots = Slots.of(root, old)
    intent = _Intent(spark, slots, old, start)
    intent.add(silver=months)
    written = _merge_silver(spark, slots, new, months, total_order)
    silver = stored(spark, slots.new, "silver", STORED_SILVER)
    if slots.old is None:
        low, high = silver.agg(F.min("obs_date"), F.max("obs_date")).first()
        n, relabelled, reached, touched = written, False, None, None
        bounds = {"min_date": None, "max_date": None}
    else:
        write_parquet(changes(spark, slots.old, slots.new, months), slots.new.path("changes"))
        changed = spark.read.parquet(slots.new.path("changes"))
        low, high, added, relabelled = changed.agg(
            F.min("obs_date"), F.max("obs_date"), F.count_if(F.col("_was").isNull()),
            F.coalesce(F.bool_or(F.col("_was") != F.col(LABEL)), F.lit(False)),
        ).first()
        n = slots.old.info["counts"]["silver"] + added
        touched = [] if low is None else _months(changed)
        reached = _reached(spark, slots, changed, touched[0]) if touched else []
        intent.add(long=reached, tails=sorted({m // 100 for m in touched}))
        bounds = {k: slots.old.info[k] for k in ("min_date", "max_date")}
    dates = sorted(str(d) for d in (low, high, *bounds.values()) if d is not None)
    said |= {"min_date": dates[0] if dates else None, "max_date": dates[-1] if dates else None, "behind": None}
    if slots.old is not None:
        said["behind"] = {"silver": months, "long": reached, "tails": sorted({m // 100 for m in touched})}
    _write_tails(spark, slots, None if slots.behind is None else sorted({*slots.behind["tails"], *said["behind"]["tails"]}))
    _write_long(spark, slots, reached, total_order)
    if touched == [] and slots.old.info["window"] == window:  # nothing differs: the same wide table
        days = _copy_wide(spark, slots, said)
    else:
        days = _write_wide(spark, slots, said, months, relabelled, window, total_order)
    said["counts"] = {"indicators_long": n, "indicators_wide": days, "silver": n}
    return publish(spark, slots.new, said, intent.pointer)


def read_long(spark: SparkSession, release: Release) -> DataFrame:
    return stored(spark, release, "indicators_long", STORED_LONG).select(*LONG_COLUMNS)


def read_silver(spark: SparkSession, release: Release) -> DataFrame:
    return stored(spark, release, "silver", STORED_SILVER).select(*SILVER_COLUMNS)

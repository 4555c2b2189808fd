"""Silver: one observation per (source, indicator_id, obs_date).

Several pulls can carry the same key. A real observation beats a synthetic
one; among equals the caller's tie-break decides (newest pull first when the
rows carry pull lineage), then the larger value, so the pick never depends
on row arrival order.

Plan: ``row_number() = 1`` over the key. Catalyst turns it into a partial
``WindowGroupLimit`` *before* the shuffle (a map-side top-1 per key) and a
final one after, so a hot key that holds a third of all rows is cut to one
row per input partition before anything moves.

That top-1 sorts what a task scans. ``DEDUPE_SPLIT`` (``session.scan_splits``)
and ``ROWS_A_FILE`` of the conformed table bound a task's rows, whatever the
table's size: it sorts in memory and does not spill. The sort compares the
series id first, as the source is the same for most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indtables.schemas import SILVER_COLUMNS

SILVER_KEY = ["source", "indicator_id", "obs_date"]
SORTED_KEY = ["indicator_id", "obs_date", "source"]
# Bytes of files, and rows of a file, that a task sorts before the shuffle.
DEDUPE_SPLIT = 16 << 20
ROWS_A_FILE = 1_000_000
# Lineage columns written by the bronze scan; newest pull wins a tie.
PULL_STAMP = "_pull_stamp"
PULLED_AT = "_pulled_at"
PULL_FILE = "_pull_file"


def default_tie_break(df: DataFrame) -> list[Column]:
    """Newest pull first: by the stamp in the document or its name, which
    survives copies and restores; then by file time and file name."""
    order = []
    if PULL_STAMP in df.columns:
        order.append(F.col(PULL_STAMP).desc_nulls_last())
    if PULLED_AT in df.columns:
        order.append(F.col(PULLED_AT).desc())
    if PULL_FILE in df.columns:
        order.append(F.col(PULL_FILE).desc())
    return order


def dedupe_observations(
    obs: DataFrame, tie_break: Sequence[Column] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Keep rank 1 per key: ``is_fallback`` ascending, then ``tie_break``,
    then value descending and label ascending. Returns the silver columns
    (plus ``carry``, e.g. the pull lineage, so a later run can merge new
    rows into this result: the pick is a maximum under a total order, so
    ``dedupe(previous result + new rows) == dedupe(all rows)``)."""
    order = [F.col("is_fallback").asc()]
    order += list(default_tie_break(obs) if tie_break is None else tie_break)
    order += [F.col("value").desc(), F.col("indicator_label").asc()]
    w = Window.partitionBy(*SORTED_KEY).orderBy(*order)
    out = obs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return out.select(*SILVER_COLUMNS, *carry)


def enforce_not_null(df: DataFrame, columns: Sequence[str] = tuple(SILVER_COLUMNS)) -> DataFrame:
    """Not-null contract checked while the rows stream by (no extra scan):
    a NULL in any listed column fails the job that materialises ``df``.

    Written as a filter that is true for good rows and raises otherwise, so
    the columns and the plan's row order are left untouched."""
    cond = F.lit(True)
    for c in reversed(list(columns)):
        fail = F.raise_error(F.lit(f"NULL in not-null column {c}")).cast("boolean")
        cond = F.when(F.col(c).isNull(), fail).otherwise(cond)
    return df.filter(cond)

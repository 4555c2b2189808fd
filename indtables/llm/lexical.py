"""Column expressions and small training helpers shared by the two tree
classifiers; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def share(col: Column, chars: str) -> Column:
    """Share of the characters of ``col`` in a regex class; 0 if empty."""
    n = F.length(col)
    return F.when(n > 0, (n - F.length(F.regexp_replace(col, f"[{chars}]", ""))) / n).otherwise(0.0)


def entropy(col: Column) -> Column:
    """Bits per character; 0 if empty."""
    n = F.length(col)

    def term(c: Column) -> Column:
        p = (n - F.length(F.replace(col, c, F.lit("")))) / n
        return -p * F.log2(p)

    chars = F.filter(F.array_distinct(F.split(col, "")), lambda c: F.length(c) > 0)
    return F.when(n > 0, F.aggregate(F.transform(chars, term), F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def rates(labelled: DataFrame, key: str, prior: float = 10.0) -> DataFrame:
    """(key, rate): the share of ``label`` = 1 per value, smoothed towards one
    half. At most as many rows as ``labelled``, which is bounded."""
    found = labelled.groupBy(key).agg(F.sum("label").alias("yes"), F.count("*").alias("n"))
    return found.select(key, ((F.col("yes") + prior / 2) / (F.col("n") + prior)).alias(f"{key}_rate"))


def with_rates(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Add each table's rate, one half where the value was never labelled."""
    for key, table in tables.items():
        df = df.join(F.broadcast(table), key, "left").fillna(0.5, [f"{key}_rate"])
    return df


def fold_in_turn(h: str, order: list[str], label: Column) -> Column:
    """Folds 0-4 dealt in turn within each label, by hash: the first row of a
    label goes to fold 2, the next ones to 0, 4, 3, 1, so that a label of three
    rows is in the shares (0, 1), the fit (2, 3) and the held-out fold (4). For
    bounded tables only: a label is one window."""
    turn = F.row_number().over(Window.partitionBy(label).orderBy(h, *order))
    return F.element_at(F.array(*[F.lit(f) for f in (1, 2, 0, 4, 3)]), (turn % 5 + 1).cast("int"))


def sample(labelled: DataFrame, order: list[str], bound: int) -> DataFrame:
    """At most ``bound`` rows: of each label, 1 and not 1, up to half of
    ``bound``, those of the smallest hash of ``order``. So a rare label is not
    crowded out, however many rows the other one has. Adds ``fold`` (0-4) and
    ``weight``, by which both labels count the same."""
    rows = labelled.withColumn("h", F.xxhash64(*order, F.lit(42)))
    yes = F.col("label") == 1
    some = [rows.filter(c).orderBy("h", *order).limit(max(bound // 2, 1)) for c in (yes, ~yes)]
    own = F.count("*").over(Window.partitionBy(yes))
    return (
        some[0].unionByName(some[1])
        .withColumn("fold", fold_in_turn("h", order, yes))
        .withColumn("weight", F.lit(float(bound)) / own).drop("h")
    )

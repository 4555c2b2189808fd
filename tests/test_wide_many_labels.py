"""Wide tables of more labels than one aggregate pivots."""

import datetime as dt

from pyspark.sql import functions as F

from indtables.operators.wide import gold_wide, pivot_dense, tall_rows

DAYS = [dt.date(2026, 1, d) for d in (1, 2, 3, 4)]
ROWS = [(DAYS[0], "a", 1.0), (DAYS[0], "A", 2.0), (DAYS[2], "b.c`d", 3.0), (DAYS[2], "a", None), (DAYS[2], "", 0.0),
        (DAYS[2], "other", 9.0)]
LABELS = ["", "A", "a", "b.c`d", "never"]


def test_many_labels_need_no_join_and_no_expression_per_label(spark):
    silver = spark.range(30).select(
        F.lit("s").alias("source"), F.col("id").cast("string").alias("indicator_id"),
        F.col("id").cast("string").alias("indicator_label"), F.lit(DAYS[0]).alias("obs_date"),
        F.col("id").cast("double").alias("value"), F.lit(False).alias("is_fallback"))
    wide = gold_wide(silver, group=3)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "pivotfirst" not in text
    assert tall_rows(wide).count() == 30


def test_many_labels_give_the_pivots_cells(spark):
    """Every day of the calendar, unknown labels left out, nulls kept."""
    dense = spark.createDataFrame(ROWS, "calendar_date date, indicator_label string, value double")
    wide = pivot_dense(dense, LABELS, DAYS[0], DAYS[-1], group=1)
    assert wide.columns == ["calendar_date", "unlabelled", "A", "a_2", "b.c`d", "never"]
    assert sorted(tuple(r) for r in wide.collect()) == [
        (DAYS[0], None, 2.0, 1.0, None, None), (DAYS[1], None, None, None, None, None),
        (DAYS[2], 0.0, None, None, 3.0, None), (DAYS[3], None, None, None, None, None)]


def test_tall_rows_are_those_of_unpivot(spark):
    dense = spark.createDataFrame(ROWS, "calendar_date date, indicator_label string, value double")
    for group in (1, 1000):
        wide = pivot_dense(dense, LABELS, DAYS[0], DAYS[-1], group=group)
        back = tall_rows(wide)
        some = [f"`{c.replace('`', '``')}`" for c in wide.columns[1:]]
        plain = wide.unpivot("calendar_date", some, "indicator_label", "value")
        assert back.columns == plain.columns
        assert sorted(map(str, back.collect())) == sorted(map(str, plain.collect()))
    empty = tall_rows(spark.createDataFrame([], "calendar_date date"))
    assert empty.columns == back.columns and empty.count() == 0

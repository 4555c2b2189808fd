"""Plain relational tables read as observation facts.

Any table with a series key, a date and a number can feed the indicator
tables; these two mappings are the ones the checks and the bench use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def observations(
    df: DataFrame,
    source: str,
    indicator_id: Column,
    obs_date: Column,
    value: Column,
    is_fallback: Column,
    indicator_label: Column | None = None,
    keep: list[str | Column] | tuple[str | Column, ...] = (),
) -> DataFrame:
    """Project a table onto the conformed observation columns (+ ``keep``)."""
    return df.select(
        F.lit(source).alias("source"),
        indicator_id.cast("string").alias("indicator_id"),
        (indicator_id if indicator_label is None else indicator_label).cast("string").alias("indicator_label"),
        obs_date.cast("date").alias("obs_date"),
        value.cast("double").alias("value"),
        is_fallback.alias("is_fallback"),
        *keep,
    )


def orders_observations(orders: DataFrame) -> DataFrame:
    """orders: one series per order priority, dated by order date, valued by
    total price; finished orders ('F') stand for synthetic rows."""
    return observations(
        orders,
        "orders",
        F.col("o_orderpriority"),
        F.col("o_orderdate"),
        F.col("o_totalprice"),
        F.col("o_orderstatus") == "F",
        keep=["o_orderkey"],
    )


def orders_tie_break() -> list[Column]:
    return [F.col("o_orderkey").desc()]


def lineitem_observations(
    lineitem: DataFrame, value: str = "l_extendedprice", series: str = "l_suppkey"
) -> DataFrame:
    """lineitem: one series per supplier (or part), dated by ship date; returned lines
    ('R') stand for synthetic rows."""
    return observations(
        lineitem,
        "lineitem",
        F.col(series),
        F.col("l_shipdate"),
        F.col(value),
        F.col("l_returnflag") == "R",
        keep=["l_orderkey", "l_linenumber", "l_partkey"],
    )


def lineitem_tie_break() -> list[Column]:
    return [F.col("l_orderkey").desc(), F.col("l_linenumber").desc(), F.col("l_partkey").desc()]

"""Driver tables shaped as bronze documents of the two feeds.

The checks need bronze input that grows with the given tables, so each
order (or line item) becomes one document. The shaping exercises every
parsing rule on real rows: absent optional fields, the ``N/E`` and empty
missing markers, one- and two-digit days, all period forms, and (in feed B)
malformed periods and numbers that must land in the reject table.

Rules (all data-driven):

feed A, one document per order
  pulled_at    the order key as sortable text, after an optional prefix
  is_fallback  true for status 'F', absent otherwise
  idSerie      the priority, absent for '5-LOW'
  fecha        dd/MM/yyyy, or d/M/yyyy for '3-MEDIUM'; ISO (malformed) for
               '4-NOT SPECIFIED' with status 'O'
  dato         'N/E' for status 'P', else the price with two decimals; with
               status 'O' malformed: 'NaN' for '2-HIGH' in December, a 'd'
               after the number for '1-URGENT' in December, a number past all
               range for '1-URGENT' in November

feed B, one document per order
  label        lower-cased priority, absent for '3-MEDIUM'
  TIME_PERIOD  yyyy for '5-LOW', yyyy/M for '4-NOT SPECIFIED', yyyy/ for
               '2-HIGH', yyyy/MM otherwise; yyyy/Qn for '1-URGENT' with
               status 'O' (malformed)
  OBS_VALUE    '' for status 'P'; the price + ' MXN' for '2-HIGH' with
               status 'O' (malformed); else the price with two decimals
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.schemas import FEED_A_SCHEMA, FEED_B_SCHEMA


def money_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def stamp(key: Column, prefix: str = "0") -> Column:
    """A pull stamp that sorts as ``key`` does, after ``prefix``."""
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 19, "0"))


def orders_feed_a_docs(orders: DataFrame, value: Column | None = None, prefix: str = "0") -> DataFrame:
    """``value``: the text of a good value (default: the price)."""
    status, prio, d = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    value = money_text(F.col("o_totalprice")) if value is None else value
    is_open, month = status == "O", F.month(d)
    fecha = (
        F.when(is_open & (prio == "4-NOT SPECIFIED"), F.date_format(d, "yyyy-MM-dd"))
        .when(prio == "3-MEDIUM", F.date_format(d, "d/M/yyyy"))
        .otherwise(F.date_format(d, "dd/MM/yyyy"))
    )
    dato = (
        F.when(status == "P", F.lit("N/E"))
        .when(is_open & (prio == "2-HIGH") & (month == 12), F.lit("NaN"))
        .when(is_open & (prio == "1-URGENT") & (month == 12), F.concat(value, F.lit("d")))
        .when(is_open & (prio == "1-URGENT") & (month == 11), F.lit("1e400"))
        .otherwise(value)
    )
    series = F.struct(
        F.when(prio != "5-LOW", prio).alias("idSerie"),
        F.lit(None).cast("string").alias("titulo"),
        F.array(F.struct(fecha.alias("fecha"), dato.alias("dato"))).alias("datos"),
    )
    return orders.select(
        F.col("o_orderkey").alias("pull_id"),
        F.when(status == "F", F.lit(True)).alias("is_fallback"),
        stamp(F.col("o_orderkey"), prefix).alias("pulled_at"),
        F.struct(F.array(series).alias("series")).alias("bmx"),
    )


def orders_feed_b_docs(orders: DataFrame) -> DataFrame:
    status, prio, d = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    year = F.date_format(d, "yyyy")
    period = (
        F.when((prio == "1-URGENT") & (status == "O"), F.concat(year, F.lit("/Q"), F.quarter(d).cast("string")))
        .when(prio == "5-LOW", year)
        .when(prio == "4-NOT SPECIFIED", F.date_format(d, "yyyy/M"))
        .when(prio == "2-HIGH", F.concat(year, F.lit("/")))
        .otherwise(F.date_format(d, "yyyy/MM"))
    )
    price = money_text(F.col("o_totalprice"))
    value = (
        F.when(status == "P", F.lit(""))
        .when((prio == "2-HIGH") & (status == "O"), F.concat(price, F.lit(" MXN")))
        .otherwise(price)
    )
    series = F.struct(
        prio.alias("INDICADOR"),
        F.array(F.struct(period.alias("TIME_PERIOD"), value.alias("OBS_VALUE"))).alias("OBSERVATIONS"),
    )
    return orders.select(
        F.col("o_orderkey").alias("pull_id"),
        F.when(status == "F", F.lit(True)).alias("is_fallback"),
        F.when(prio != "3-MEDIUM", F.lower(prio)).alias("label"),
        F.array(series).alias("Series"),
    )


def lineitem_feed_b_docs(lineitem: DataFrame, value: Column | None = None) -> DataFrame:
    """One feed B document per line item: supplier series, monthly period."""
    value = money_text(F.col("l_extendedprice")) if value is None else value
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    point = F.struct(F.date_format("l_shipdate", "yyyy/MM").alias("TIME_PERIOD"), value.alias("OBS_VALUE"))
    series = F.struct(F.col("l_suppkey").cast("string").alias("INDICADOR"), F.array(point).alias("OBSERVATIONS"))
    return lineitem.select(
        key.alias("pull_id"),
        (F.col("l_returnflag") == "R").alias("is_fallback"),
        stamp(key).alias("pulled_at"),
        F.lit("supplier").alias("label"),
        F.array(series).alias("Series"),
    )


def as_json_text(docs: DataFrame, keep: str = "pull_id") -> DataFrame:
    """Documents as JSON text (NULL fields are left out, i.e. absent)."""
    body = [c for c in docs.columns if c != keep]
    return docs.select(keep, F.to_json(F.struct(*body)).alias("json"))


def from_json_text(texts: DataFrame, feed: str, keep: str = "pull_id") -> DataFrame:
    """Decode JSON text with the feed's schema (feed "a" or "b")."""
    schema = FEED_A_SCHEMA if feed == "a" else FEED_B_SCHEMA
    return texts.select(keep, F.from_json("json", schema).alias("d")).select(keep, "d.*")

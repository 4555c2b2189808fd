"""Table schemas: bronze documents of both feeds, silver, gold long."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

# The field names of both feeds and the columns of the tables.
# ``pulled_at`` (optional) is the UTC stamp of the pull, as sortable text.
# Feed A document: {is_fallback, bmx: {series: [{idSerie, titulo, datos: [{fecha, dato}]}]}}
FEED_A_POINT = StructType([StructField("fecha", StringType()), StructField("dato", StringType())])
FEED_A_SERIES = StructType(
    [
        StructField("idSerie", StringType()),
        StructField("titulo", StringType()),
        StructField("datos", ArrayType(FEED_A_POINT)),
    ]
)
FEED_A_SCHEMA = StructType(
    [
        StructField("is_fallback", BooleanType()),
        StructField("pulled_at", StringType()),
        StructField("bmx", StructType([StructField("series", ArrayType(FEED_A_SERIES))])),
    ]
)

# Feed B document: {is_fallback, label, Series: [{INDICADOR, OBSERVATIONS: [{TIME_PERIOD, OBS_VALUE}]}]}
FEED_B_POINT = StructType([StructField("TIME_PERIOD", StringType()), StructField("OBS_VALUE", StringType())])
FEED_B_SERIES = StructType(
    [StructField("INDICADOR", StringType()), StructField("OBSERVATIONS", ArrayType(FEED_B_POINT))]
)
FEED_B_SCHEMA = StructType(
    [
        StructField("is_fallback", BooleanType()),
        StructField("pulled_at", StringType()),
        StructField("label", StringType()),
        StructField("Series", ArrayType(FEED_B_SERIES)),
    ]
)

SILVER_COLUMNS = ["source", "indicator_id", "indicator_label", "obs_date", "value", "is_fallback"]
SILVER_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("indicator_id", StringType(), False),
        StructField("indicator_label", StringType(), False),
        StructField("obs_date", DateType(), False),
        StructField("value", DoubleType(), False),
        StructField("is_fallback", BooleanType(), False),
    ]
)

LONG_COLUMNS = SILVER_COLUMNS + ["change_pct", "rolling_avg_30d"]
LONG_SCHEMA = StructType(
    list(SILVER_SCHEMA.fields)
    + [StructField("change_pct", DoubleType(), True), StructField("rolling_avg_30d", DoubleType(), True)]
)

# Rejected conformed rows (decision D5): the raw text plus a reason.
REJECT_SCHEMA = StructType(
    [
        StructField("source", StringType()),
        StructField("indicator_id", StringType()),
        StructField("raw_date", StringType()),
        StructField("raw_value", StringType()),
        StructField("reason", StringType()),
    ]
)


def with_field(schema: StructType, name: str, kind) -> StructType:
    """A copy of ``schema`` with one more field."""
    return StructType([*schema.fields, StructField(name, kind)])

"""Gold table scans (Parquet, typed CSV) with a clear missing-table
error."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indtables.functions.names import named
from indtables.schemas import LONG_SCHEMA

_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _is_missing(e: AnalysisException) -> bool:
    return (e.getCondition() or "") in _MISSING or "Unable to infer schema" in str(e)


def missing_table(path: str) -> FileNotFoundError:
    return FileNotFoundError(
        f"No gold table at {path}: run the refresh (indtables.plans.refresh.run) to build it first."
    )


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table at ``path``. A missing or empty folder raises
    ``FileNotFoundError`` naming the path and the remedy; other errors pass
    through unchanged."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if _is_missing(e):
            raise missing_table(path) from e
        raise


def read_csv_typed(spark: SparkSession, path: str, schema: StructType = LONG_SCHEMA) -> DataFrame:
    """Header row, comma, UTF-8, explicit types (dates, doubles and
    booleans are never guessed). Empty fields read as NULL."""
    try:
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("encoding", "UTF-8")
            .option("dateFormat", "yyyy-MM-dd")
            .csv(path)
        )
    except AnalysisException as e:
        if _is_missing(e):
            raise missing_table(path) from e
        raise


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """S4 for the wide table, whose columns depend on the data: the header
    names them; ``calendar_date`` is a DATE, every other column a DOUBLE."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    cols = [F.col("calendar_date").cast("date").alias("calendar_date")]
    cols += [named(c).cast("double").alias(c) for c in raw.columns if c != "calendar_date"]
    return raw.select(*cols)

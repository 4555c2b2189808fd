"""Q1-Q4: gold tables behind a small SQL surface.

``query_long("WHERE ... ORDER BY ...")`` appends the caller's SQL tail to
``SELECT * FROM indicators_long``. The result is a lazy DataFrame; filters
and projections in the tail reach the Parquet scan (pushdown, pruning).
The dialect is Spark SQL. Values are bound, never spliced: ``args`` holds what
the tail's markers (``:name``, or ``?`` in order) stand for. The two tables are
named for the one statement only, so catalogs of several releases can be queried
side by side in one session.
"""

from __future__ import annotations

import argparse

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.sinks.writers import write_csv, write_csv_file
from indtables.sources.gold import read_gold

LONG_VIEW = "indicators_long"
WIDE_VIEW = "indicators_wide"


class GoldCatalog:
    """The two gold tables, from paths (read lazily) or from DataFrames."""

    def __init__(
        self,
        spark: SparkSession,
        long: str | DataFrame,
        wide: str | DataFrame,
    ) -> None:
        self.spark = spark
        self._long = long
        self._wide = wide

    def _frame(self, t: str | DataFrame) -> DataFrame:
        return read_gold(self.spark, t) if isinstance(t, str) else t

    def long(self) -> DataFrame:
        return self._frame(self._long)

    def wide(self) -> DataFrame:
        return self._frame(self._wide)

    def register(self) -> None:
        """Views of both tables, for a session that holds one catalog."""
        self.long().createOrReplaceTempView(LONG_VIEW)
        self.wide().createOrReplaceTempView(WIDE_VIEW)

    def _query(self, view: str, sql_suffix: str, args: dict[str, Any] | list | None) -> DataFrame:
        tail = sql_suffix.replace("{", "{{").replace("}", "}}")
        text = (f"WITH {LONG_VIEW} AS (SELECT * FROM {{long_}}), {WIDE_VIEW} AS (SELECT * FROM {{wide_}}) "
                f"SELECT * FROM {view} {tail}")
        return self.spark.sql(text, args=args, long_=self.long(), wide_=self.wide())

    def query_long(self, sql_suffix: str = "", args: dict[str, Any] | list | None = None) -> DataFrame:
        """Q1: ``SELECT * FROM indicators_long <sql_suffix>``; the tail may name
        either table."""
        return self._query(LONG_VIEW, sql_suffix, args)

    def query_wide(self, sql_suffix: str = "", args: dict[str, Any] | list | None = None) -> DataFrame:
        """Q2: ``SELECT * FROM indicators_wide <sql_suffix>``."""
        return self._query(WIDE_VIEW, sql_suffix, args)

    def row_counts_frame(self) -> DataFrame:
        """Q3 as a DataFrame: (table_name, row_count), one row per table."""
        def count(df: DataFrame, name: str) -> DataFrame:
            return df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )

        return count(self.long(), LONG_VIEW).unionByName(count(self.wide(), WIDE_VIEW))

    def row_counts(self) -> dict[str, int]:
        """Q3: ``{"indicators_long": n, "indicators_wide": m}`` (two numbers
        reach the driver, no rows)."""
        return {r["table_name"]: r["row_count"] for r in self.row_counts_frame().collect()}

    def export_csv(self, out_dir: str, single_file: bool = False) -> list[str]:
        """Both tables as CSV under ``out_dir``; returns the two paths.
        Folders of parts, or with ``single_file`` the files
        ``indicators_long.csv`` and ``indicators_wide.csv`` (one writing task each,
        see ``write_csv_file``)."""
        out = out_dir.rstrip("/")
        order = ["source", "indicator_id", "obs_date"]
        if single_file:
            return [write_csv_file(self.long(), f"{out}/{LONG_VIEW}.csv", order),
                    write_csv_file(self.wide(), f"{out}/{WIDE_VIEW}.csv", ["calendar_date"])]
        return [write_csv(self.long(), f"{out}/{LONG_VIEW}_csv", order_by=order),
                write_csv(self.wide(), f"{out}/{WIDE_VIEW}_csv", order_by=["calendar_date"])]


def catalog(spark: SparkSession, out_root: str) -> GoldCatalog:
    """The gold tables that the last refresh published under ``out_root``; they
    stay those of that refresh while later ones publish theirs."""
    from indtables.plans.refresh import published

    tables = published(spark, out_root)
    return GoldCatalog(spark, tables.long(), tables.wide())


def query_long(spark: SparkSession, out_root: str, sql_suffix: str = "", args=None) -> DataFrame:
    """``SELECT * FROM indicators_long <sql_suffix>`` over a refresh output."""
    return catalog(spark, out_root).query_long(sql_suffix, args)


def query_wide(spark: SparkSession, out_root: str, sql_suffix: str = "", args=None) -> DataFrame:
    """``SELECT * FROM indicators_wide <sql_suffix>`` over a refresh output."""
    return catalog(spark, out_root).query_wide(sql_suffix, args)


def row_counts(spark: SparkSession, out_root: str) -> dict[str, int]:
    """``{"indicators_long": n, "indicators_wide": m}`` of a refresh output."""
    return catalog(spark, out_root).row_counts()


def main(argv: list[str] | None = None) -> None:
    """Export both gold tables of a refresh output root to CSV."""
    p = argparse.ArgumentParser(description="Export the gold tables to CSV.")
    p.add_argument("out_root", help="the refresh output root")
    p.add_argument("export_dir")
    p.add_argument("--single-file", action="store_true", help="exactly one CSV file per table")
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    cat = catalog(spark, args.out_root)
    paths = cat.export_csv(args.export_dir, single_file=args.single_file)
    print(paths, cat.row_counts())


if __name__ == "__main__":
    main()

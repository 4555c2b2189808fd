"""Sinks: bronze append, Parquet replace, CSV export."""

from indtables.sinks.writers import write_bronze, write_csv, write_parquet

__all__ = ["write_bronze", "write_csv", "write_parquet"]

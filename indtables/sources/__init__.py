"""Sources: bronze JSON scan, gold Parquet/CSV scans, synthetic series and
the fallback choice, and mappings of plain tables onto observations."""

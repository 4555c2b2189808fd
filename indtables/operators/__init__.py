"""Table-level operators: conform, dedupe, long, wide, reports."""

"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage; each module's docstring says what it does with nulls, empty
and very long texts, ties, repeated rows, empty tables and extra columns."""

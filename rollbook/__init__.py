"""Institutional reporting on Spark: tidy-data operators with stated rules for
missing values, order and duplicates, and the reporting jobs built from them."""

__version__ = "0.1.0"

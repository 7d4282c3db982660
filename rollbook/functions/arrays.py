"""Functions on list columns; each works within its row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def list_sum(c: Column) -> Column:
    """Sum of a list of numbers; NULL when an element is missing, 0 for an empty list."""
    return F.aggregate(c, F.lit(0.0), lambda total, x: total + x.cast("double"))


def list_mean(c: Column) -> Column:
    """Mean of a list; NULL for an empty list or one with a missing element."""
    return F.when(F.size(c) > 0, list_sum(c) / F.size(c))


def list_length(c: Column) -> Column:
    return F.size(c)


def is_empty_list(c: Column) -> Column:
    """TRUE for NULL and for a list without elements."""
    return c.isNull() | (F.size(c) == 0)


def null_if_empty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)

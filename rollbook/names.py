"""Helpers for column names and for the order and key arguments used everywhere.

Keys are names, or (left, right) pairs where the two sides differ. An order is a list
of names; a leading "-" sorts that column descending. Missing values come last both ways.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Key = str | tuple[str, str]


def quoted(name: str) -> str:
    """A column name for SQL text, exact also when it holds dots, blanks, '@' or '/'."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    """A text or number as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def col(name: str) -> Column:
    """A column by its exact name."""
    return F.col(quoted(name))


def cols(names: Sequence[str]) -> list[Column]:
    return [col(n) for n in names]


def pairs(on: Key | Sequence[Key]) -> list[tuple[str, str]]:
    if isinstance(on, str) or (isinstance(on, tuple) and len(on) == 2):
        on = [on]
    return [(k, k) if isinstance(k, str) else k for k in on]


def parse_order(order: str | Sequence[str]) -> list[tuple[str, bool]]:
    """[(name, descending)]"""
    order = [order] if isinstance(order, str) else order
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def sort_columns(order: str | Sequence[str], reverse: bool = False) -> list[Column]:
    out = []
    for name, descending in parse_order(order):
        if reverse:
            out.append(col(name).asc_nulls_first() if descending else col(name).desc_nulls_first())
        else:
            out.append(col(name).desc_nulls_last() if descending else col(name).asc_nulls_last())
    return out

"""Conditional values, with the two- and three-valued logic stated per function."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F


def is_in(c: Column, values: Sequence) -> Column:
    """Membership that is FALSE, never NULL, for a missing value."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def if_else(condition: Column, yes: Column, no: Column) -> Column:
    """NULL where the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def case_when(*branches: tuple[Column, object], default: object = None) -> Column:
    """First branch that holds wins."""
    out = None
    for condition, value in branches:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if default is None else out.otherwise(default)


def recode(c: Column, pairs: Iterable[tuple[str, object]] | Mapping[str, object]) -> Column:
    """Text by a list of pairs, unmatched to NULL; of a repeated key the first pair counts."""
    if isinstance(pairs, Mapping):
        pairs = pairs.items()
    first: dict[str, object] = {}
    for key, value in pairs:
        first.setdefault(key, value)
    return case_when(*[(c == key, F.lit(value)) for key, value in first.items()])


def code_of(c: Column, codes: Mapping[str, object]) -> Column:
    """Value of a code table, NULL for names it does not hold."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return F.try_element_at(table, c)


def yes_no_code(c: Column, yes: int = 1, no: int = 2) -> Column:
    """TRUE to 1, FALSE to 2, missing stays missing."""
    return F.when(c, F.lit(yes)).when(~c, F.lit(no))


def band(c: Column, bands: Mapping[str, Sequence], other: str) -> Column:
    """Name of the band whose list holds the value; also a missing value is "other"."""
    return case_when(*[(is_in(c, values), F.lit(name)) for name, values in bands.items()],
                     default=F.lit(other))


def fill_empty_text(c: Column, other: Column) -> Column:
    """The other column, as text, where this one is empty or missing."""
    return F.when(c.isNull() | (c == ""), other.cast("string")).otherwise(c)


def strict_sum(c: Column) -> Column:
    """Sum that is NULL as soon as one value is missing."""
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def sum_present(c: Column) -> Column:
    """Sum of the values present, 0 without any."""
    return F.coalesce(F.sum(c), F.lit(0).cast("double"))


def count_distinct_with_missing(c: Column) -> Column:
    """Distinct values, all missing ones counted together as one more."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))

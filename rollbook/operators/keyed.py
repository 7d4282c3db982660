"""The null-safe left join every other operator builds on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame

from ..names import Key, col, pairs


def match(on: Sequence[tuple[str, str]], missing_match: bool = True) -> Column:
    if missing_match:
        return reduce(and_, [col(l).eqNullSafe(col(r)) for l, r in on])
    return reduce(and_, [col(l) == col(r) for l, r in on])


def private_keys(right: DataFrame, on: Sequence[tuple[str, str]]):
    """Rename the right keys, so that the two sides share no key name."""
    private = {r: f"__right_key_{i}" for i, (_, r) in enumerate(on)}
    return right.withColumnsRenamed(private), [(l, private[r]) for l, r in on]


def left_join(left: DataFrame, right: DataFrame, on: Key | Sequence[Key],
              missing_match: bool = True) -> DataFrame:
    """Left join on keys with the same or different names; the right keys are dropped. Nothing is counted
    beforehand: Catalyst and AQE know the sizes of files and shuffles, broadcast a small right side and split hot keys."""
    right, on = private_keys(right, pairs(on))
    clash = {c for c in left.columns} & {c for c in right.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    return left.join(right, match(on, missing_match), "left").drop(*[r for _, r in on])

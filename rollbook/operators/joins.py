"""Joins and look-ups. Missing keys match missing keys unless stated otherwise.

Catalyst broadcasts a side whose size it knows to be under spark.sql.autoBroadcastJoinThreshold,
AQE does so on measured sizes, and otherwise a sort-merge join runs whose skewed partitions
AQE splits. No side gets a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..names import Key, col, cols, pairs
from ..session import split_skewed_joins
from .keyed import left_join, match, private_keys
from .windows import keep_first


def left_join_coalesce(left: DataFrame, right: DataFrame, on: Key | Sequence[Key],
                       columns: Sequence[str], prefer: str = "right") -> DataFrame:
    """Left join where both sides hold `columns`; each becomes the preferred side's value,
    or the other side's where that is missing."""
    if prefer not in ("left", "right"):
        raise ValueError("prefer must be 'left' or 'right'")
    other = {c: f"__other_{i}" for i, c in enumerate(columns)}
    joined = left_join(left, right.withColumnsRenamed(other), on)
    merged = {}
    for c, o in other.items():
        both = (col(o), col(c)) if prefer == "right" else (col(c), col(o))
        merged[c] = F.coalesce(*both)
    return joined.withColumns(merged).drop(*other.values())


def left_join_checked(left: DataFrame, right: DataFrame, on: Key | Sequence[Key],
                      relationship: str = "many-to-one") -> DataFrame:
    """Left join that fails while it runs when a row has several partners.

    many-to-one: no left row may match several right rows. one-to-one: in addition no right
    row may match several left rows. Repeated keys that match nothing are no error.
    Repeats are counted per key before the join, so they never multiply rows.
    """
    if relationship not in ("many-to-one", "one-to-one"):
        raise ValueError("relationship must be 'many-to-one' or 'one-to-one'")
    split_skewed_joins(left.sparkSession)
    on = pairs(on)
    value_columns = [c for c in right.columns if c not in {r for _, r in on}]
    payload = F.first(F.struct(*cols(value_columns))) if value_columns else F.lit(None)
    single = right.groupBy(*cols([r for _, r in on])).agg(
        F.count(F.lit(1)).alias("__right_rows"), payload.alias("__right"))
    joined = left_join(left, single, on)
    joined = joined.filter(
        F.when(col("__right_rows") > 1,
               F.raise_error(F.lit(f"join is not {relationship}: several right rows for one key")))
        .otherwise(F.lit(True)))
    if relationship == "one-to-one":
        repeated = (left.groupBy(*cols([l for l, _ in on]))
                    .agg(F.count(F.lit(1)).alias("__left_rows")).filter(col("__left_rows") > 1))
        joined = left_join(joined, repeated, [l for l, _ in on]).filter(
            F.when(col("__right_rows").isNotNull() & (col("__left_rows") > 1),
                   F.raise_error(F.lit("join is not one-to-one: several left rows for one key")))
            .otherwise(F.lit(True))).drop("__left_rows")
    values = [col("__right").getField(c).alias(c) for c in value_columns]
    return joined.select(*cols(left.columns), *values)


def semi(left: DataFrame, right: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """Rows whose key is in the other table."""
    on = pairs(on)
    right, on = private_keys(right.select(*cols([r for _, r in on])), on)
    return left.join(right, match(on), "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """Rows whose key is not in the other table."""
    on = pairs(on)
    right, on = private_keys(right.select(*cols([r for _, r in on])), on)
    return left.join(right, match(on), "left_anti")


def translate(df: DataFrame, mapping: DataFrame, current: str, new: str,
              keep_original: bool = True) -> DataFrame:
    """Add the column `new` of a mapping table by the value of `current`."""
    out = left_join(df, mapping.select(*cols([current, new])), current)
    return out if keep_original else out.drop(current)


def bind_reference(c: Column, entity: str) -> Column:
    """An id as the reference text "entity(id)"; stays NULL without an id."""
    return F.concat(F.lit(entity + "("), c.cast("string"), F.lit(")"))


def lookup_reference(df: DataFrame, reference: DataFrame, on: Key | Sequence[Key], id_column: str,
                     entity: str, out: str, order: Sequence[str] | None = None) -> DataFrame:
    """Find an id and write it as "entity(id)", NULL without a match. Of several matches the
    first in `order` counts (default: the smallest id). Missing keys match nothing."""
    on = pairs(on)
    right_keys = [r for _, r in on]
    wanted = list(dict.fromkeys(right_keys + [id_column] + [o.lstrip("-") for o in order or []]))
    first = keep_first(reference.select(*cols(wanted)), right_keys, order or [id_column])
    first = first.select(*cols(right_keys), col(id_column).alias("__id"))
    joined = left_join(df, first, on, missing_match=False)
    return joined.withColumn(out, bind_reference(col("__id"), entity)).drop("__id")


def lookup_either_key(df: DataFrame, reference: DataFrame, key: str, either: Sequence[Column],
                      id_column: str, entity: str, out: str) -> DataFrame:
    """Find an id where the key equals any one of several expressions over the reference.

    The reference is spread to one row per key it answers to, so the OR is an equi-join.
    Of several ids for a key the smallest counts.
    """
    spread = (reference.select(F.explode(F.array(*either)).alias("__key"), col(id_column).alias("__id"))
              .filter(col("__key").isNotNull())
              .groupBy("__key").agg(F.min("__id").alias("__id")))
    joined = left_join(df, spread, (key, "__key"), missing_match=False)
    return joined.withColumn(out, bind_reference(col("__id"), entity)).drop("__id")


def reconcile(computed: DataFrame, expected: DataFrame, on: Key | Sequence[Key],
              compare: Sequence[tuple[str, str]], equal: bool = True,
              null_safe: bool = False) -> DataFrame:
    """Join computed rows with expected ones and add, per (computed, expected) column pair,
    `<computed>_equal` and the difference `<computed>_difference`, always by name."""
    joined = left_join(computed, expected, on)
    added = {}
    for ours, theirs in compare:
        if equal:
            same = col(ours).eqNullSafe(col(theirs)) if null_safe else col(ours) == col(theirs)
            added[f"{ours}_equal"] = same
        added[f"{ours}_difference"] = col(ours) - col(theirs)
    return joined.withColumns(added)

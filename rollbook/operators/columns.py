"""Choosing, renaming and combining columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.arrays import is_empty_list
from ..names import col, cols, literal, quoted


def names_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def names_matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*cols(names_matching(df, pattern)))


def drop_prefixes(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.select(*cols([c for c in df.columns if not c.startswith(prefixes)]))


def to_front(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*cols(first), *cols([c for c in df.columns if c not in first]))


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return rename_all(df, lambda c: c.removeprefix(prefix))


def rename_by_documentation(df: DataFrame, naming: DataFrame | Mapping[str, str],
                            old: str = "from", new: str = "to") -> DataFrame:
    """Rename through a naming table; names it does not hold stay. Two columns with one new
    name raise. Of the table only the rows for columns of `df` reach the driver."""
    if isinstance(naming, Mapping):
        rules = {o: n for o, n in naming.items() if o in df.columns}
    else:
        wanted = naming.filter(col(old).isin(list(df.columns))).select(old, new).distinct()
        found = wanted.limit(2 * len(df.columns) + 1).collect()
        rules = {row[old]: row[new] for row in found}
        if len(found) != len(rules):
            raise ValueError("the naming table gives a column several names")
    target = [rules.get(c, c) for c in df.columns]
    if len(set(target)) != len(target):
        raise ValueError("the naming table gives several columns one name")
    return df.toDF(*target)


def syntactic_name(name: str) -> str:
    """Letters, digits, dots and underscores only, not starting with a digit or underscore."""
    out = re.sub(r"[^\w.]", ".", name)
    return out if re.match(r"([^\W\d_]|\.(?!\d))", out) else "X" + out


def repair_names(names: Sequence[str]) -> list[str]:
    """Syntactic and unique names: repeats get .1, .2 and so on, skipping names in use."""
    syntactic = [syntactic_name(n) for n in names]
    used, out, number = set(syntactic), [], {}
    seen: set[str] = set()
    for name in syntactic:
        if name not in seen:
            seen.add(name)
            out.append(name)
            continue
        i = number.get(name, 0) + 1
        while f"{name}.{i}" in used:
            i += 1
        number[name] = i
        used.add(f"{name}.{i}")
        out.append(f"{name}.{i}")
    return out


def with_repaired_names(df: DataFrame) -> DataFrame:
    return df.toDF(*repair_names(df.columns))


def add_constants(df: DataFrame, names: Sequence[str], value: object = 0) -> DataFrame:
    return df.withColumns({n: F.lit(value) for n in names})


def numeric_names(df: DataFrame, doubles_only: bool = False) -> list[str]:
    kind = T.DoubleType if doubles_only else T.NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def zero_missing_numbers(df: DataFrame, doubles_only: bool = False) -> DataFrame:
    """0 for every missing value in numeric (or only double) columns."""
    return zero_missing(df, numeric_names(df, doubles_only))


def zero_missing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.coalesce(col(n), F.lit(0).cast(df.schema[n].dataType)) for n in names})


def total_of(names: Sequence[str]) -> Column:
    """Sum across columns, missing values skipped."""
    return reduce(add, [F.coalesce(col(n), F.lit(0)) for n in names])


def sum_of(names: Sequence[str]) -> Column:
    """Sum across columns, missing if one of them is."""
    return reduce(add, cols(names))


def mean_of(names: Sequence[str]) -> Column:
    """Mean across columns, missing if one of them is."""
    return sum_of(names) / len(names)


def pick_by_name(name_column: str, sources: Mapping[str, str], existing: Sequence[str]) -> Column:
    """The value of the column that belongs to the name in `name_column`; NULL for other names
    and for names whose column does not exist."""
    branches = [f"WHEN {quoted(name_column)} = {literal(name)} THEN {quoted(source)}"
                for name, source in sources.items() if source in existing]
    return F.expr(f"CASE {' '.join(branches)} END") if branches else F.lit(None)


def clear_if_all_empty(df: DataFrame, target: str, companions: Sequence[str]) -> DataFrame:
    """NULL for `target` where every companion list is NULL or empty."""
    all_empty = reduce(lambda a, b: a & b, [is_empty_list(col(c)) for c in companions])
    return df.withColumn(target, F.when(~all_empty, col(target)))


def columns_with_values(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per column: whether any row holds a value."""
    names = list(names or df.columns)
    flags = df.agg(*[F.coalesce(F.bool_or(col(n).isNotNull()), F.lit(False)).alias(n) for n in names])
    return flags.unpivot([], cols(names), "column", "has_value")

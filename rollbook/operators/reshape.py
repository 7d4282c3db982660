"""Wide and long forms, united and unnested columns. Pivots name their values, so the
columns do not depend on the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.strings import text_or_na
from ..names import col, cols, literal, quoted
from .columns import zero_missing


def unite(df: DataFrame, out: str, names: Sequence[str], sep: str = "-") -> DataFrame:
    """Paste columns to one and drop them; a missing part shows as NA."""
    united = F.concat_ws(sep, *[text_or_na(col(n)) for n in names])
    return df.select(*cols([c for c in df.columns if c not in names]), united.alias(out))


def _single(names_from: str, name: object, value: str) -> str:
    """SQL for a cell's one value; several rows for a cell raise. Wide pivots have many cells,
    which as SQL text take one call each to build."""
    here = f"{quoted(names_from)} = {literal(name)}"
    return (f"CASE WHEN count_if(coalesce({here}, false)) > 1 THEN raise_error('several rows for one cell of the pivot') "
            f"ELSE max(CASE WHEN {here} THEN {quoted(value)} END) END")


def _checked(cells: list[str], names_from: str, values: Sequence, others: str) -> list[str]:
    """The cells, the first of which raises for a label that is not listed, unless `others` is "drop"."""
    if others not in ("raise", "drop"):
        raise ValueError("others must be 'raise' or 'drop'")
    if others == "drop" or not cells:
        return cells
    listed = ", ".join(literal(v) for v in values)
    return [f"CASE WHEN count_if(coalesce({quoted(names_from)} NOT IN ({listed}), false)) > 0 "
            f"THEN raise_error('a label that is not listed') ELSE {cells[0]} END", *cells[1:]]


def pivot_wide(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
               values: Sequence, fill: object | None = None, prefix: str = "", others: str = "raise") -> DataFrame:
    """One column per listed value of `names_from`; absent cells are NULL, or `fill`.
    A cell with several rows raises, and so does a label that is not listed, unless `others` is "drop"."""
    cells = _checked([_single(names_from, v, values_from) for v in values], names_from, values, others)
    cells = [F.expr(c).alias(f"{prefix}{v}") for c, v in zip(cells, values)]
    wide = df.groupBy(*cols(ids)).agg(*cells)
    if fill is None:
        return wide
    return wide.withColumns({f"{prefix}{v}": F.coalesce(col(f"{prefix}{v}"), F.lit(fill)) for v in values})


def pivot_count(df: DataFrame, ids: Sequence[str], label: Column, labels: Sequence[str],
                total: str | None = None) -> DataFrame:
    """Rows per label as columns, 0 where there are none. The total counts all rows of the
    group, also those with a label not listed. One aggregation, no second pass."""
    counts = [F.expr(f"count_if(coalesce(__label = {literal(x)}, false))").alias(x) for x in labels]
    if total:
        counts.append(F.count(F.lit(1)).alias(total))
    return df.select(*cols(ids), label.alias("__label")).groupBy(*cols(ids)).agg(*counts)


def pivot_wide_values(df: DataFrame, ids: Sequence[str], names_from: str,
                      values_from: Sequence[str], values: Sequence[str], others: str = "raise") -> DataFrame:
    """Several value columns at once, named <value column>_<name>. Labels that are not listed as in `pivot_wide`."""
    named = {f"{m}_{v}": _single(names_from, v, m) for m in values_from for v in values}
    cells = _checked(list(named.values()), names_from, values, others)
    return df.groupBy(*cols(ids)).agg(*[F.expr(c).alias(n) for n, c in zip(named, cells)])


def pivot_wide_lists(df: DataFrame, ids: Sequence[str], label: str, groups: Mapping[str, Sequence[str]],
                     values_from: Sequence[str], others: str = "raise") -> DataFrame:
    """Raw labels mapped to fewer names: each cell is the list of its raw labels' values. Labels that are not listed as
    in `pivot_wide`.

    A list has at most as many elements as its name has raw labels, and is built from one
    buffer per raw label rather than by collecting rows. Cells without a value are NULL.
    Two rows with the same ids and raw label raise.
    """
    lists = {}
    for measure in values_from:
        for name, raw in groups.items():
            single = ", ".join(_single(label, r, measure) for r in sorted(raw))
            lists[f"{measure}_{name}"] = f"array_compact(array({single}))"
    cells = _checked(list(lists.values()), label, [r for raw in groups.values() for r in raw], others)
    wide = df.groupBy(*cols(ids)).agg(*[F.expr(c).alias(n) for n, c in zip(lists, cells)])
    names = [quoted(c) for c in wide.columns if c not in ids]
    return wide.selectExpr(*[quoted(i) for i in ids], *[f"CASE WHEN size({n}) > 0 THEN {n} END AS {n}" for n in names])


def pivot_long(df: DataFrame, columns: Sequence[str], names_to: str, values_to: str) -> DataFrame:
    """The listed columns to name and value rows; rows with a missing value stay."""
    ids = [c for c in df.columns if c not in columns]
    return df.unpivot(cols(ids), cols(columns), names_to, values_to)


def pivot_long_values(df: DataFrame, columns: Sequence[str], names_to: str) -> DataFrame:
    """Columns named <measure>_<name>, split at the last underscore, to one row per name with
    one column per measure. A measure without a column for a name is NULL."""
    split = [c.rpartition("_") for c in columns]
    measures = list(dict.fromkeys(m for m, _, _ in split))
    names = list(dict.fromkeys(n for _, _, n in split))
    kinds = {m: next(df.schema[f"{m}_{n}"].dataType for m2, _, n in split if m2 == m) for m in measures}
    rows = [F.struct(F.lit(n).alias(names_to),
                     *[(col(f"{m}_{n}") if f"{m}_{n}" in columns else F.lit(None).cast(kinds[m])).alias(m)
                       for m in measures]) for n in names]
    ids = [c for c in df.columns if c not in columns]
    return df.select(*cols(ids), F.inline(F.array(*rows)))


def pivot_wide_labelled(df: DataFrame, ids: Sequence[str], label: str, groups: Mapping[str, Sequence[str]],
                        values_from: Sequence[str], others: str = "raise") -> DataFrame:
    """Raw labels mapped to fewer names: each cell is the sorted list of (label, value) of its raw labels that occur, so that
    cells of several measures can be put side by side by label (`unnest_labelled`). A value may be missing; a cell without any
    label is NULL. Two rows with the same ids and raw label raise; labels that are not listed as in `pivot_wide`."""
    lists = {}
    for measure in values_from:
        for name, raw in groups.items():
            pairs = ", ".join(
                f"CASE WHEN count_if(coalesce({quoted(label)} = {literal(r)}, false)) > 0 "
                f"THEN named_struct('label', {literal(r)}, 'value', {_single(label, r, measure)}) END" for r in sorted(raw))
            lists[f"{measure}_{name}"] = f"array_compact(array({pairs}))"
    cells = _checked(list(lists.values()), label, [r for raw in groups.values() for r in raw], others)
    wide = df.groupBy(*cols(ids)).agg(*[F.expr(c).alias(n) for n, c in zip(lists, cells)])
    names = [quoted(c) for c in wide.columns if c not in ids]
    return wide.selectExpr(*[quoted(i) for i in ids], *[f"CASE WHEN size({n}) > 0 THEN {n} END AS {n}" for n in names])


def unnest_labelled(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Unnest cells of (label, value), with the cells that belong together under one name: they share slots by label.

    A name's labels are those of any of its cells, in order; its nth label stands in the row's nth slot, as the column of that
    name, with each cell's value for the label, NULL where that cell lacks it. A name with fewer labels than another is
    NULL in the further slots, whatever the number of its labels; a row without any label is dropped. A label twice in a cell takes the first value."""
    def labels(cells: Sequence[str]) -> str:
        every = ", ".join(f"coalesce({quoted(c)}.label, array())" for c in cells)
        return f"array_sort(array_distinct(array_compact(concat({every}))))"

    held = {name: f"__labels_{i}" for i, name in enumerate(groups)}
    rows = df.select("*", *[F.expr(labels(cells)).alias(held[name]) for name, cells in groups.items()])
    most = F.greatest(*[F.size(h) for h in held.values()], F.lit(0))
    slots = rows.select("*", F.explode(F.when(most > 0, F.sequence(F.lit(1), most))).alias("__slot"))
    columns = {c: name for name, cells in groups.items() for c in cells}
    at = {name: f"try_element_at({h}, __slot)" for name, h in held.items()}
    picked = [f"get(filter({quoted(c)}, x -> x.label = {at[columns[c]]}), 0).value AS {quoted(c)}" if c in columns else quoted(c) for c in df.columns]
    return slots.selectExpr(*picked, *[f"{sql} AS {quoted(name)}" for name, sql in at.items()])


def unnest_parallel(df: DataFrame, columns: Sequence[str], place: str | None = None, unequal: str = "raise") -> DataFrame:
    """Unnest several list columns together. A list of one is repeated, a missing or empty list
    gives NULL and a row without any element is dropped. Other lengths that differ raise; with `unequal="null"`
    the shorter lists give NULL beyond their end. `place` keeps the position in the list as a column of that name."""
    if unequal not in ("raise", "null"):
        raise ValueError("unequal must be 'raise' or 'null'")
    sizes = "array(" + ", ".join(f"coalesce(size({quoted(c)}), 0)" for c in columns) + ")"
    # the check sits in the generator: a filter would be pushed down with a copy of every list
    check = (f"WHEN size(filter(array_distinct({sizes}), n -> n > 1)) > 1 "
             f"THEN raise_error('lists of different lengths in one row')") if unequal == "raise" else ""
    places = f"CASE {check} WHEN array_max({sizes}) > 0 THEN sequence(1, array_max({sizes})) END"
    i = quoted(place or "__i")
    kept = df.select("*", F.explode(F.expr(places)).alias(place or "__i"))
    picked = {quoted(c): f"try_element_at({quoted(c)}, if(size({quoted(c)}) = 1, 1, {i}))" for c in columns}
    out = kept.selectExpr(*[f"{picked[n]} AS {n}" if (n := quoted(c)) in picked else n for c in kept.columns])
    return out if place else out.drop("__i")


def first_of_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The first row that `unnest_parallel(unequal="null")` makes of each row, without making the others: every list's first
    element, for the rows that have any element."""
    some = " OR ".join(f"size({quoted(c)}) > 0" for c in columns)
    kept = df.filter(F.expr(some)) if columns else df
    return kept.selectExpr(*[f"try_element_at({quoted(c)}, 1) AS {quoted(c)}" if c in columns else quoted(c) for c in df.columns])


def nested_field(df: DataFrame, nested: str, field: str) -> Column:
    """List of one field of a nested table; NULL where the table has no such field."""
    element = df.schema[nested].dataType.elementType
    if field not in element.fieldNames():
        return F.lit(None)
    return col(nested).getField(field)

"""Order-dependent operators. Each names its order; groups of any size are handled by
`prefix_scan`, or by the pruning of first rows before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..names import col, cols, parse_order, sort_columns
from ..session import split_skewed_joins
from .keyed import left_join
from .prefix_scan import ordered_parts


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "row_number",
                parts: int | None = None) -> DataFrame:
    """Row number by group in the stated order; without keys over the whole table."""
    scan = ordered_parts(df, keys, order, parts)
    earlier = scan.part_window().rowsBetween(Window.unboundedPreceding, -1)
    offsets = scan.sizes().select(*cols(scan.by), F.sum("__rows").over(earlier).alias("__offset"))
    numbered = scan.attach(scan.df.withColumn(out, F.row_number().over(scan.window()).cast("long")), offsets)
    return scan.finish(numbered.withColumn(out, col(out) + F.coalesce(col("__offset"), F.lit(0))).drop("__offset"))


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int,
             out: str = "rank") -> DataFrame:
    """First k rows per group with their rank. Spark prunes each task to k rows per key before
    the shuffle, so a hot key costs no more than any other."""
    window = Window.partitionBy(*cols(keys)).orderBy(*sort_columns(order))
    return df.withColumn(out, F.row_number().over(window)).filter(col(out) <= k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole first row per key in the stated order."""
    return top_rows(df, keys, order, 1, "__first").drop("__first")


def fill_from_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """Missing values become the previous row's original value: one step, no chain."""
    scan = ordered_parts(df, keys, order, parts)
    window = scan.window()
    work = scan.df.withColumns({"__place": F.row_number().over(window),
                                **{f"__lag_{i}": F.lag(col(c)).over(window) for i, c in enumerate(columns)}})
    # the first row of a part takes over from the last row of the part before
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = scan.summaries(columns, __last=F.last(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)])).over(whole))
    work = scan.attach(work, last.select(*cols(scan.by), F.lag("__last").over(scan.part_window()).alias("__carry")))
    work = work.withColumns({
        c: F.coalesce(col(c), F.when(col("__place") == 1, col("__carry").getField(f"c{i}")).otherwise(col(f"__lag_{i}")))
        for i, c in enumerate(columns)})
    return scan.finish(work.drop("__place", "__carry", *[f"__lag_{i}" for i in range(len(columns))]))


def fill_down_up(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                 parts: int | None = None) -> DataFrame:
    """Per group the last value carried forward, then the first one backward.

    Only rows before the group's first value are left for the backward step, so they take the
    first value of the whole group: a frame computed once, where one from each row to the end
    would be computed again for every row.
    """
    scan = ordered_parts(df, keys, order, parts)
    down = scan.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = scan.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    work = scan.df.withColumns({
        f"__{kind}_{i}": value for i, c in enumerate(columns)
        for kind, value in (("before", F.last(col(c), True).over(down)), ("first", F.first(col(c), True).over(whole)))})
    ends = scan.summaries(columns, **{
        f"__{kind}_{i}": value for i, c in enumerate(columns)
        for kind, value in (("end", F.last(col(c), True).over(whole)), ("start", F.first(col(c), True).over(whole)))})
    earlier = scan.part_window().rowsBetween(Window.unboundedPreceding, -1)
    later = scan.part_window().rowsBetween(1, Window.unboundedFollowing)
    work = scan.attach(work, ends.select(*cols(scan.by), *[
        value for i in range(len(columns))
        for value in (F.last(f"__end_{i}", True).over(earlier).alias(f"__down_{i}"), F.first(f"__start_{i}", True).over(later).alias(f"__up_{i}"))]))
    kinds = ["before", "down", "first", "up"]
    filled = work.withColumns({c: F.coalesce(*[col(f"__{kind}_{i}") for kind in kinds]) for i, c in enumerate(columns)})
    return scan.finish(filled.drop(*[f"__{kind}_{i}" for i in range(len(columns)) for kind in kinds]))


def attach(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Group values on every row. The groups are aggregated first and joined back, so each task
    sends one row per key, and AQE may split the rows of a hot key over several join tasks."""
    split_skewed_joins(df.sparkSession)
    groups = df.groupBy(*cols(keys)).agg(*aggregates)
    return left_join(df, groups, list(keys))


def fill_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Missing values become the group's first value present. The first values are aggregated, a row per key from each
    task, and joined back: no window and no search for hot groups."""
    order = [order] if isinstance(order, str) else list(order)
    first = {c: f"__first_{i}" for i, c in enumerate(columns)}
    if any(descending for _, descending in parse_order(order)):
        # a struct can not be compared downwards; each column's first row is pruned in the tasks instead
        work = df
        for c, f in first.items():
            rows = df.filter(col(c).isNotNull())
            # private names, as a value column may also be a key or in the order
            rows = keep_first(rows.withColumn(f, col(c)), keys, order).select(*cols(keys), col(f))
            work = left_join(work, rows, list(keys))
    else:
        place = F.struct(*[p for n, _ in parse_order(order) for p in (col(n).isNull(), col(n))])
        work = attach(df, keys, *[F.min_by(col(c), F.when(col(c).isNotNull(), place)).alias(f) for c, f in first.items()])
    return work.withColumns({c: F.coalesce(col(c), col(f)) for c, f in first.items()}).drop(*first.values())


def collapse_text(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], out: str,
                  sep: str = ", ", part_rows: int | None = 100_000, parts: int | None = None) -> DataFrame:
    """The group's texts joined in order, duplicates kept, missing ones as NA.

    A group of more than `part_rows` rows gives several rows, numbered by `part`, whose texts
    follow on each other: no cell and no task holds an unbounded group. `part_rows=None` puts
    the parts together to one cell per group, which must then fit in memory.
    """
    size = part_rows or 100_000
    wanted = list(dict.fromkeys([*keys, value, *[o.lstrip("-") for o in order]]))
    placed = number_rows(df.select(*cols(wanted)), keys, order, "__place", parts)
    placed = placed.withColumn("part", ((col("__place") - 1) / size).cast("long"))
    text = F.coalesce(col(value).cast("string"), F.lit("NA"))
    texts = (placed.select(*cols(keys), "part", "__place", text.alias("__text"))
             .groupBy(*cols(keys), "part")
             .agg(F.expr(f"listagg(`__text`, '{sep}') WITHIN GROUP (ORDER BY `__place`)").alias(out)))
    if part_rows is not None:
        return texts
    return texts.groupBy(*cols(keys)).agg(
        F.expr(f"listagg(`{out}`, '{sep}') WITHIN GROUP (ORDER BY part)").alias(out))

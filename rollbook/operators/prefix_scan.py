"""Ordered work on groups of any size, as a parallel prefix scan.

A window puts a whole group into one task. That is fine until one key holds a large part of all rows. Here the rows of such keys
are cut along the order into parts, a window over (keys, part) does the local work, each part gives a summary of one
row, a scan over the summaries gives what every part takes over from those before (or after) it, and that is joined back.

Where to cut comes from a sample of fixed size: the rows whose hash is least, so that it is the same whenever a lost
task or another branch of the plan computes it again. Everything is part of one plan: building it starts no job. The sample only
chooses the cuts; results are the same for any choice, and all rows go the exact way. Rows that tie in the order are
cut by a hash of all their columns; only rows equal in every column always stay together.

The number of parts is that of the shuffle's partitions: a key is cut if it would fill more than about two of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from ..names import col, cols, parse_order, sort_columns
from ..session import ORDERED_PARTS, int_setting

PART = "__part"
CUTS = "__cuts"
TIE = "__tie"
WHOLE = "__whole_table"
SAMPLE_PER_PART = 32


def _comes_before(cut: Column, order: Sequence[str]) -> Column:
    """Whether a cut point sorts strictly before the row, missing values last."""
    before, same = F.lit(False), F.lit(True)
    for i, (name, descending) in enumerate(parse_order(order)):
        c, r = cut.getField(f"c{i}"), col(name)
        smaller = c > r if descending else c < r
        here = c.isNotNull() & (r.isNull() | smaller)
        before = before | (same & F.coalesce(here, F.lit(False)))
        same = same & c.eqNullSafe(r)
    return before


def _part_of(cuts: Column, order: Sequence[str], parts: int) -> Column:
    """Number of cut points before the row, by binary search."""
    def halve(state: Column, _: Column) -> Column:
        low, high = state.getField("low"), state.getField("high")
        middle = ((low + high) / 2).cast("int")
        after = _comes_before(F.get(cuts, middle), order)
        return (F.when(low >= high, state)
                .when(after, F.struct((middle + 1).alias("low"), high.alias("high")))
                .otherwise(F.struct(low.alias("low"), middle.alias("high"))))

    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(parts.bit_length() + 1))
    found = F.aggregate(steps, start, halve, lambda state: state.getField("low"))
    return F.when(cuts.isNull(), F.lit(0)).otherwise(found)


def join_bounded(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a table of at most a few rows for each part of the plan, missing keys matching. The sample bounds
    it, whatever the size of the data, so it is broadcast."""
    renamed = table.withColumnsRenamed({k: k + "__small" for k in keys})
    same = reduce(and_, [col(k).eqNullSafe(col(k + "__small")) for k in keys])
    return df.join(F.broadcast(renamed), same, "left").drop(*[k + "__small" for k in keys])


def _cut_points(rows: DataFrame, keys: list[str], order: list[str], parts: int) -> DataFrame:
    """An ordered array of rows to cut at, for each key that fills two parts or more of the sample."""
    names = [n for n, _ in parse_order(order)]
    wanted = list(dict.fromkeys(keys + names))
    drawn = rows.select(*cols(wanted)).orderBy(F.xxhash64(col(TIE), F.lit(1)), col(TIE)).limit(parts * SAMPLE_PER_PART)
    group = Window.partitionBy(*cols(keys))
    placed = drawn.select(
        *cols(keys), F.row_number().over(group.orderBy(*sort_columns(order))).alias("__place"),
        F.count(F.lit(1)).over(group).alias("__drawn"),
        F.struct(*[col(n).alias(f"c{i}") for i, n in enumerate(names)]).alias("__row"))
    cut = placed.filter((col("__drawn") >= 2 * SAMPLE_PER_PART) & (col("__place") % SAMPLE_PER_PART == 0) & (col("__place") < col("__drawn")))
    ordered = F.array_sort(F.collect_list(F.struct("__place", "__row")))
    return cut.groupBy(*cols(keys)).agg(F.transform(ordered, lambda x: x.getField("__row")).alias(CUTS))


@dataclass
class OrderedParts:
    """Rows with their part, and the keys and order to build windows from."""

    df: DataFrame
    keys: list[str]
    order: list[str]

    @property
    def by(self) -> list[str]:
        return self.keys + [PART]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*cols(self.by)).orderBy(*sort_columns(self.order))

    def part_window(self) -> WindowSpec:
        return Window.partitionBy(*cols(self.keys)).orderBy(PART)

    def rows_of_cut_keys(self, columns: Sequence[str] = ()) -> DataFrame:
        wanted = list(dict.fromkeys([*self.by, *[n for n, _ in parse_order(self.order)], *columns]))
        return self.df.filter(col(CUTS).isNotNull()).select(*cols(wanted))

    def sizes(self) -> DataFrame:
        """(keys, part, __rows) of the keys that are cut."""
        return self.rows_of_cut_keys().groupBy(*cols(self.by)).agg(F.count(F.lit(1)).alias("__rows"))

    def summaries(self, columns: Sequence[str], **values: Column) -> DataFrame:
        """One row for each part of the keys that are cut: values of windows that are the same on all rows of a part."""
        rows = self.rows_of_cut_keys(columns).withColumns({**values, "__first": F.row_number().over(self.window())})
        return rows.filter(col("__first") == 1).select(*cols(self.by), *values)

    def attach(self, df: DataFrame, summaries: DataFrame) -> DataFrame:
        return join_bounded(df, summaries, self.by)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(PART, CUTS, WHOLE, TIE)


def ordered_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> OrderedParts:
    """Cut the rows of keys that hold more than about 2 / `parts` of all rows along `order`, each to parts of about
    1 / `parts`. Without keys the whole table is one group. `parts` is the number of shuffle partitions, unless
    given or set as spark.rollbook.orderedParts."""
    spark = df.sparkSession
    parts = parts or int_setting(spark, ORDERED_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    if not keys:
        # a column Spark cannot fold away, so that joins on it stay equi-joins
        first = parse_order(order)[0][0]
        df = df.withColumn(WHOLE, F.coalesce(F.pmod(F.xxhash64(col(first)), F.lit(1)), F.lit(0)))
        keys = [WHOLE]
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = df.withColumn(TIE, F.xxhash64(*cols(hashed)))
    points = _cut_points(rows, keys, [*order, TIE], parts)
    work = join_bounded(rows, points, keys)
    work = work.withColumn(PART, _part_of(col(CUTS), [*order, TIE], parts))
    return OrderedParts(work.withColumn(CUTS, F.when(col(CUTS).isNotNull(), F.lit(True))), keys, order)

"""Finance lines to one amount per faculty, field and year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.conditions import sum_present
from ..names import col, cols
from ..operators.joins import left_join, translate
from ..operators.reshape import pivot_long
from ..operators.tables import keep_label_or_latest, sort_rows
from ..operators.windows import collapse_text

# Amount columns of the export, and the name of the field in the mapping table.
THIS_YEAR = "YTD Realisatie"
LAST_YEAR = "YTD Realisatie vorig jaar"
FIELD = "Mapping veld"
LINE_KEYS = ["Faculteit", "Jaar", FIELD, "Toewijzing"]
CELL_KEYS = ["Faculteit", FIELD, "Jaar"]


def finance_lines(inputs: Mapping[str, DataFrame], order: Sequence[str], strict_max: bool = False) -> DataFrame:
    """Mapped lines, one row per amount column, last year's amount moved to its own year.

    As written the rule "last year's amounts, or this year's in the last year" looks for the
    last year within groups of one year, so it keeps every row whose year is known.
    `strict_max` looks for it among all years of the line.
    """
    named = translate(inputs["finance_export"], inputs["finance_mapping"], "Toewijzing", FIELD)
    named = named.filter(col("Toewijzing").isNotNull() & col(FIELD).isNotNull())
    named = named.select(*cols(dict.fromkeys(["Faculteit", "Jaar", FIELD, "Toewijzing", *order])),
                         col(LAST_YEAR).cast("double").alias(LAST_YEAR), col(THIS_YEAR).cast("double").alias(THIS_YEAR))
    lines = pivot_long(named, [LAST_YEAR, THIS_YEAR], "Year", "Waarde")
    is_last = col("Year") == LAST_YEAR
    year = col("Jaar").cast("int")
    lines = lines.withColumns({"Jaar": F.when(is_last, year - 1).otherwise(year),
                               "amount_order": F.when(is_last, 0).otherwise(1)})
    if strict_max:
        return keep_label_or_latest(lines, ["Faculteit", FIELD, "Toewijzing"], "Jaar", "Year", LAST_YEAR, THIS_YEAR)
    return lines.filter(is_last | col("Jaar").isNotNull())


def finance_long(inputs: Mapping[str, DataFrame], order: Sequence[str], strict_max: bool = False,
                 names: bool = True, part_rows: int = 100_000) -> DataFrame:
    """`inputs`: finance_export, finance_mapping. `order` is the place of a line in its source.

    A row for each amount, with its lines' names as one text. For groups of every size that text comes in numbered
    parts of at most `part_rows` names; the amount stands on part 0 alone. `names=False` leaves out parts and names.
    """
    lines = finance_lines(inputs, order, strict_max)
    # with one number as the place, the amounts are summed in a hash aggregation
    place = col(order[0]) if len(order) == 1 else F.struct(*cols(order))
    summed = lines.groupBy(*cols(CELL_KEYS)).agg(
        sum_present(col("Waarde")).alias("Waarde"), F.min(place).alias("first_line"))
    out = ["Faculteit", col(FIELD).alias("Veldnaam"), "Waarde", "Jaar"]
    if not names:
        return sort_rows(summed.select(*out, "first_line"), ["Faculteit", "Jaar", "first_line"]).drop("first_line")
    texts = collapse_text(lines, CELL_KEYS, "Toewijzing", [*order, "amount_order"], "Naam_intern", part_rows=part_rows)
    named = left_join(texts, summed, CELL_KEYS).withColumn("Waarde", F.when(col("part") == 0, col("Waarde")))
    return sort_rows(named.select(*out, "part", "Naam_intern", "first_line"), ["Faculteit", "Jaar", "first_line", "part"]).drop("first_line")


def finance_names(inputs: Mapping[str, DataFrame], order: Sequence[str], strict_max: bool = False,
                  part_rows: int = 100_000) -> DataFrame:
    """The names behind every amount, in source order, in parts of at most `part_rows` lines."""
    lines = finance_lines(inputs, order, strict_max)
    texts = collapse_text(lines, CELL_KEYS, "Toewijzing", [*order, "amount_order"], "names", part_rows=part_rows)
    return texts.withColumnRenamed(FIELD, "Veldnaam")

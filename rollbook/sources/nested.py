"""Nested sources: activity tables with a sub-table per row, and paged JSON feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import academic_year
from ..functions.strings import extract
from ..names import col
from ..operators.columns import names_matching
from ..session import shared_folder


def keep_activity_files(activities: DataFrame, file_column: str = "ter_source_file",
                        pattern: str = r"activities_20[0-9]{2}.rds$") -> DataFrame:
    """Rows of the yearly activity files, with the year and academic year of the file name."""
    year = extract(col(file_column), "20[0-9]{2}").cast("int")
    return (activities.filter(col(file_column).rlike(pattern)).withColumn("jaar", year)
            .withColumn("unl_jaar", academic_year(col("jaar"))))


def chain_positions(links: DataFrame) -> DataFrame:
    """Position, from 0, of every node of one chain given as (node, next), where the last node's `next` is missing.

    List ranking by pointer doubling: every node knows the node some steps on and the number of steps; each round joins the
    table with itself and doubles them, so a chain of n nodes takes log2 n rounds, none of them in one task. A node that
    is there twice or missing, a second chain and a cycle raise ValueError."""
    spark = links.sparkSession
    shared_folder(spark)
    held = links.select("node", "next").checkpoint()  # the rounds below read it again and again
    n, nodes, ends, targets, known = held.agg(
        F.count(F.lit(1)), F.countDistinct("node"), F.count_if(F.col("next").isNull()), F.countDistinct("next"), F.count("node")).first()
    if known < n:
        raise ValueError("a page has no address")
    if nodes < n:
        repeated = held.groupBy("node").count().filter("count > 1").select("node").first()["node"]
        raise ValueError(f"the page {repeated} is there twice")
    lost = held.filter("next IS NOT NULL").join(held.select(F.col("node").alias("next")), "next", "left_anti").select("next").first()
    if lost:
        raise ValueError(f"the page {lost['next']} is missing")
    if n and ends == 0:
        raise ValueError("the pages' links make a cycle")
    if ends > 1 or targets < n - ends:
        raise ValueError(f"the pages are {max(ends, 2)} chains, not one")
    ranked = held.select("node", "next", F.when(F.col("next").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("steps"))
    for _ in range(max(n - 1, 0).bit_length()):
        on = ranked.select(F.col("node").alias("next"), F.col("next").alias("further"), F.col("steps").alias("more"))
        ranked = ranked.join(on, "next", "left").select("node", F.col("further").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        ranked = ranked.checkpoint()
    if not ranked.filter("next IS NOT NULL").isEmpty():
        raise ValueError("the pages' links make a cycle")
    return ranked.select("node", (F.lit(n - 1) - F.col("steps")).alias("position"))


NEXT = "@odata.nextLink"  # fixed value: the feed's name for the next page's address


def read_json_pages(spark: SparkSession, path: str, record: T.StructType, pattern: str = "^_?unl_", multi_line: bool = True,
                    address: str | None = None, place: bool = False) -> DataFrame:
    """Records of a paged feed, landed as one JSON document per page: {"value": [...], "@odata.nextLink": ...}.

    Only record fields whose name matches are kept. An empty page adds nothing. A page holds a bounded number of records, so
    exploding it stays within one task.

    `address` names the field in which the landing kept the address each page was asked by. The links are then followed: a
    missing, repeated or cyclic page raises, so does a landing that ended early, and with `place` the columns `page` and `page_row` (from 0)
    give the order of the feed. Without `address` nothing can be followed, and pages are read as they lie.
    """
    page = T.StructType([T.StructField("value", T.ArrayType(record)), T.StructField(NEXT, T.StringType()),
                         *([T.StructField(address, T.StringType())] if address else [])])
    pages = spark.read.schema(page).option("multiLine", str(multi_line).lower()).json(path)
    if place and not address:
        raise ValueError("without the pages' addresses there is no order")
    if not address:
        records = pages.select(F.inline("value"))
        return records.select(*[col(c) for c in names_matching(records, pattern)])
    order = chain_positions(pages.select(col(address).alias("node"), col(NEXT).alias("next")))
    held = pages.join(order, col(address) == F.col("node")) if place else pages
    records = held.select(*(["position"] if place else []), F.posexplode("value").alias("__row", "__record"))
    names = [f.name for f in record if names_matching(spark.createDataFrame([], T.StructType([f])), pattern)]
    kept = [F.col("__record").getField(n).alias(n) for n in names]
    return records.select(*([F.col("position").alias("page"), F.col("__row").alias("page_row")] if place else []), *kept)

"""Connected components of a table of links, by distributed union-find.

Each round does a large star (every node's larger neighbours are linked to its least neighbour) and a small star (every
node's smaller neighbours and itself likewise). Paths shorten to a star around the least node of the component in a
number of rounds that grows with the logarithm of their length; once all are stars, the rounds end. Only least neighbours are joined back,
a row a node, and rows of a hub are combined in each task before they are shuffled; nothing reaches the driver but whether a round is the last.
Every row is read once a round and gives its two ends in the task that reads it, as rounds of few rows cost what their tasks cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import split_skewed_joins
from .common import checkpointed, files_go, let_go


def _two_rows(df: DataFrame, names: list[str], one: list[str | Column], two: list[str | Column]) -> DataFrame:
    """Two rows for each row, without a second reading of them."""
    def row(values: list[str | Column]) -> Column:
        return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in zip(names, values)])
    return df.select(F.explode(F.array(row(one), row(two))).alias("row")).select("row.*")


def _all_stars(links: DataFrame) -> bool:
    """Whether every child has one parent, and that is no child."""
    roles = _two_rows(links, ["node", "parents", "is_parent"], ["child", F.lit(1), F.lit(False)], ["parent", F.lit(0), F.lit(True)])
    roles = roles.groupBy("node").agg(F.sum("parents").alias("parents"), F.bool_or("is_parent").alias("is_parent"))
    with files_go(links.sparkSession):
        return not roles.agg(F.bool_or((F.col("parents") > 1) | ((F.col("parents") > 0) & F.col("is_parent")))).first()[0]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link to another; the component is its least node. Repeated links,
    links in both directions and links of a node with itself are allowed; those with a missing end are left out."""
    split_skewed_joins(links.sparkSession)
    pairs = links.select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent"), links[a].alias("a"), links[b].alias("b"))
    pairs = pairs.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = checkpointed(pairs.select("child", "parent").distinct())   # a child is greater than its parent, in every round
    while not _all_stars(now):
        least = _two_rows(now, ["node", "other"], ["child", "parent"], ["parent", "child"])
        least = least.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = now.join(least.withColumnRenamed("node", "parent"), "parent").select("child", F.col("least").alias("parent"))
        least = large.groupBy("child").agg(F.min("parent").alias("least"))
        small = _two_rows(large.join(least, "child"), ["child", "parent"], ["child", "least"], ["parent", "least"])
        before, now = now, checkpointed(small.filter("child != parent").distinct())
        let_go(before)
    found = checkpointed(_two_rows(now, ["node", "component"], ["child", "parent"], ["parent", "parent"]).distinct())
    let_go(now)
    return found

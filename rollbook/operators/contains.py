"""Look-ups of names inside other names.

"Is a contained in b" is no equality, and as a join condition it compares every pair. Here a needle is known by one of
its runs of `GRAM` characters (a shorter needle by itself), and each name is spread to its runs: the join is an equality
on the run, and `contains` checks what meets. Of a needle's runs the one that fewest names have is taken, by counts over all names:
what many names share brings no pairs, and a needle with a run that no name has is out at once. Names are spread only
to runs of lengths that needles have, which is one length where all needles are long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..names import col
from ..session import split_skewed_joins
from .joins import left_join

GRAM = 8


def _runs(text: Column, size: Column) -> Column:
    """The distinct runs of `size` characters of a text, which is cut to characters once."""
    characters = F.split(text, "")
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    runs = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(characters, i, size), "")))
    return F.when(F.length(text) >= size, runs)


def _needles(needles: DataFrame, needle: str) -> DataFrame:
    """(__piece, __size): each distinct needle with the length of its runs."""
    wanted = needles.select(col(needle).alias("__piece")).filter(col("__piece") != "").distinct()
    return wanted.withColumn("__size", F.least(F.length("__piece"), F.lit(GRAM)))


def spread_names(names: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """(__name, __size, __run): each distinct name with its runs of the lengths that occur among the needles."""
    held = names.select(col(name).alias("__name")).filter(col("__name") != "").distinct()
    sizes = wanted.agg(F.collect_set("__size")).scalar()  # at most GRAM numbers
    by_size = held.select("__name", F.explode(sizes).alias("__size"))
    return by_size.select("__name", "__size", F.explode(_runs(F.col("__name"), F.col("__size"))).alias("__run"))


def _anchors(wanted: DataFrame, spread: DataFrame) -> DataFrame:
    """(__piece, __size, __run): the run of each needle that fewest names have. Needles with a run that no name has are left out."""
    counts = spread.groupBy("__size", "__run").agg(F.count(F.lit(1)).alias("__names"))
    runs = wanted.select("__piece", "__size", F.explode(_runs(F.col("__piece"), F.col("__size"))).alias("__run"))
    counted = runs.join(counts, ["__size", "__run"], "left").groupBy("__piece", "__size")
    best = counted.agg(F.min_by("__run", F.struct("__names", "__run")).alias("__run"), F.count_if(F.col("__names").isNull()).alias("__absent"))
    return best.filter("__absent = 0").drop("__absent")


def _pairs(spread: DataFrame, anchors: DataFrame) -> DataFrame:
    """(__name, __piece): names with the needles in them. A run that many names have meets few needles, each distinct, so
    that AQE can cut its rows of names."""
    split_skewed_joins(spread.sparkSession)
    met = spread.join(anchors, ["__size", "__run"])
    return met.filter(F.contains(col("__name"), col("__piece"))).select("__name", "__piece")


def keep_contained(df: DataFrame, needle: str, names: DataFrame, name: str) -> DataFrame:
    """Rows whose text occurs inside any name of the other table (plain text, case as given)."""
    wanted = _needles(df, needle)
    spread = spread_names(names, name, wanted)
    anchors = _anchors(wanted, spread)
    # a needle that is its own run is known to occur; only longer ones are held against names
    short = anchors.filter(col("__run") == col("__piece")).select("__piece")
    long = _pairs(spread, anchors.filter(col("__run") != col("__piece"))).select("__piece").distinct()
    return df.join(short.unionByName(long), col(needle) == col("__piece"), "left_semi")


def replace_by_contained(df: DataFrame, name: str, needles: DataFrame, needle: str, out: str) -> DataFrame:
    """The needle contained in each name, else the name itself; of several the smallest."""
    wanted = _needles(needles, needle)
    spread = spread_names(df, name, wanted)
    found = _pairs(spread, _anchors(wanted, spread)).groupBy("__name").agg(F.min("__piece").alias("__found"))
    joined = left_join(df, found, (name, "__name"), missing_match=False)
    return joined.withColumn(out, F.coalesce(col("__found"), col(name))).drop("__found")

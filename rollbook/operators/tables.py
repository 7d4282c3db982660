"""Filters, aggregates, sorting and set operations on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..names import col, cols, sort_columns
from .keyed import left_join
from .windows import attach


def sort_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort with missing values last; end the order in a unique column to make it stable."""
    return df.orderBy(*sort_columns(order))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 1) -> DataFrame:
    return sort_rows(df, order).limit(n)


def keep_label_or_latest(df: DataFrame, keys: Sequence[str], period: str, label: str,
                         always: str, latest: str) -> DataFrame:
    """Rows labelled `always`, and rows labelled `latest` in the group's last period."""
    with_last = attach(df, keys, F.max(col(period)).alias("__last"))
    in_last = (col(period) == col("__last")) & (col(label) == latest)
    return with_last.filter((col(label) == always) | in_last).drop("__last")


def frequency_table(df: DataFrame, name: str) -> DataFrame:
    """Rows and share by value. The total is a scalar subquery over the counts, whose shuffle it
    shares, and not a window over all groups in one task."""
    counts = df.groupBy(col(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", col("n") / counts.agg(F.sum("n")).scalar())


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("n")).filter(col("n") > 1)


def list_histogram(df: DataFrame, keys: Sequence[str], values: str) -> DataFrame:
    """The group's lists taken together: distinct values and number of values, missing
    elements left out. Values are counted per task before the shuffle."""
    flat = df.select(*cols(keys), F.explode_outer(col(values)).alias("__value"))
    return flat.groupBy(*cols(keys)).agg(F.count_distinct("__value").alias("n_distinct"),
                                         F.count("__value").alias("n_values"))


def bind_rows(*tables: DataFrame, source: str | None = None) -> DataFrame:
    """Rows of all tables by column name, absent columns NULL; `source` keeps their order."""
    out = None
    for i, table in enumerate(tables):
        part = table.withColumn(source, F.lit(i)) if source else table
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def workload(df: DataFrame, keys: Sequence[str], groups: str, weeks: str, minutes: str,
             variant: str = "new") -> DataFrame:
    """Weekly teaching load per group from rows that each hold a list of weeks and of minutes.

    new: all minutes / (weeks x student groups), contact hours = all minutes / 60.
    old: mean of the rows' mean minutes, contact hours = occurrences x that mean / 60.
    Distinct weeks are counted on (keys, week) pairs and distinct groups on the rows themselves, so neither count
    repeats the rows of the other; the pairs are reduced in the tasks.
    """
    if variant not in ("new", "old"):
        raise ValueError("variant must be 'new' or 'old'")
    total = F.aggregate(col(minutes), F.lit(0.0), lambda a, x: a + x.cast("double"))
    rows = df.select(*cols(keys), col(groups).alias("__group"), col(weeks).alias("__weeks"),
                     total.alias("__minutes"), F.size(col(minutes)).alias("__count"))
    by_group = rows.groupBy(*cols(keys), "__group").agg(
        F.sum(F.coalesce(F.size(F.array_compact("__weeks")), F.lit(0))).alias("__occurrences"),
        F.sum("__minutes").alias("__minutes"), F.count_if(col("__minutes").isNull()).alias("__unknown"),
        F.sum(F.try_divide(col("__minutes"), col("__count"))).alias("__means"),
        F.count(F.try_divide(col("__minutes"), col("__count"))).alias("__with_mean"))
    summed = by_group.groupBy(*cols(keys)).agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("__occurrences").alias("__occurrences"),
        F.when(F.sum("__unknown") == 0, F.sum("__minutes")).alias("__total"),
        F.try_divide(F.sum("__means"), F.sum("__with_mean")).alias("__mean"))
    distinct = rows.select(*cols(keys), F.explode(F.array_distinct(F.array_compact("__weeks"))).alias("__week")).distinct()
    n_weeks = distinct.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("n_weeks"))
    summed = left_join(summed, n_weeks, list(keys)).withColumn("n_weeks", F.coalesce("n_weeks", F.lit(0).cast("long")))
    if variant == "new":
        load = F.try_divide(col("__total"), col("n_weeks") * col("n_groups"))
        hours = col("__total") / 60
    else:
        load = col("__mean")
        hours = col("__occurrences") * col("__mean") / 60
    return summed.select(*cols(keys), "n_groups", "n_weeks", load.alias("minutes_per_group_week"),
                         hours.alias("contact_hours"))

"""Filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.conditions import is_in
from ..names import col
from ..operators import contains, joins, tables
from .registry import query, table


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
          WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber IN (1, 2, 3)""")
def flt_conjunction(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem")
            .filter((col("l_returnflag") == "R") & (col("l_linestatus") == "O") & col("l_linenumber").isin(1, 2, 3))
            .select("l_orderkey", "l_linenumber", "l_partkey"))


@query("""SELECT o_orderkey FROM orders
          WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND nullif(o_orderpriority, '5-LOW') <> '3-MEDIUM'""")
def flt_disjunction(spark, sf_dir):
    priority = F.nullif(col("o_orderpriority"), F.lit("5-LOW"))
    return (table(spark, sf_dir, "orders")
            .filter(((col("o_orderstatus") == "F") | (col("o_orderpriority") == "1-URGENT")) & (priority != "3-MEDIUM"))
            .select("o_orderkey"))


@query("SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P') IN ('F'), false) AS done FROM orders")
def flt_membership_two_valued(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", is_in(F.nullif(col("o_orderstatus"), F.lit("P")), ["F"]).alias("done"))


@query("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL")
def flt_null(spark, sf_dir):
    labelled = joins.left_join(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")
    return labelled.filter(col("quality").isNotNull()).select("doc_id", "quality")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 1998 AND year(o_orderdate) IN (1996, 1999, 2000)")
def flt_range(spark, sf_dir):
    # bounds on the column itself reach the scan
    date = col("o_orderdate")
    years = [(date >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & (date < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz")) for y in (1996, 1999, 2000)]
    return table(spark, sf_dir, "orders").filter((date >= F.lit("1998-01-01").cast("timestamp_ntz")) & (years[0] | years[1] | years[2])).select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'bolt$')")
def flt_regex(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(col("p_name").rlike("bolt$")).select("p_partkey", "p_name")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def flt_semi(spark, sf_dir):
    builders = table(spark, sf_dir, "customer").filter(col("c_mktsegment") == "BUILDING")
    return joins.semi(table(spark, sf_dir, "orders"), builders, ("o_custkey", "c_custkey")).select("o_orderkey")


@query("""SELECT c_custkey, word FROM (
            SELECT c_custkey, (['RED W', 'D BO', 'GEAR', 'BLUEBOLT', 'OLD', 'NUT'])[c_nationkey % 6 + 1] AS word FROM customer)
          WHERE EXISTS (SELECT 1 FROM part WHERE contains(upper(p_name), word))""")
def flt_contains_any(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in ("RED W", "D BO", "GEAR", "BLUEBOLT", "OLD", "NUT")])
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", F.element_at(words, col("c_nationkey") % 6 + 1).alias("word"))
    names = table(spark, sf_dir, "part").select(F.upper("p_name").alias("NAME"))
    return contains.keep_contained(named, "word", names, "NAME")


@query("""SELECT o_orderkey FROM (
            SELECT *, max(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS last FROM orders)
          WHERE o_orderstatus = 'F' OR (year(o_orderdate) = last AND o_orderstatus = 'O')""")
def flt_group_relative(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("jaar"))
    return tables.keep_label_or_latest(orders, ["o_custkey"], "jaar", "o_orderstatus", "F", "O").select("o_orderkey")


@query("SELECT d.doc_id, lang, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE lang <> 'es'")
def flt_drop_na(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.nullif(col("lang"), F.lit("es")).alias("lang"))
    labelled = joins.left_join(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return labelled.dropna("any")

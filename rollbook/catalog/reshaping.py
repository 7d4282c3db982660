"""Pivots, unpivots and nested columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import list_mean
from ..names import col
from ..operators import reshape
from ..operators.windows import top_rows
from .registry import query, table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]
FLAGS = ["A", "N", "R"]


@query('SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS jaar, ' + ", ".join(
    f"count(*) FILTER (WHERE o_orderstatus = '{s}') AS \"{s}\"" for s in STATUSES) + " FROM orders GROUP BY 1, 2")
def pivot_wide_fill(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("jaar"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"))
    return reshape.pivot_wide(counts, ["o_custkey", "jaar"], "o_orderstatus", "n", STATUSES, fill=0)


@query('SELECT c_nationkey, c_custkey % 7 AS lot, ' + ", ".join(
    f"round(sum(c_acctbal) FILTER (WHERE c_mktsegment = '{s}'), 2) AS \"seg {s}\"" for s in SEGMENTS)
    + " FROM customer GROUP BY c_nationkey, c_custkey % 7")
def pivot_wide_null(spark, sf_dir):
    # groups so small that some have no customer of a segment
    sums = table(spark, sf_dir, "customer").groupBy("c_nationkey", (col("c_custkey") % 7).alias("lot"), "c_mktsegment").agg(
        F.round(F.sum("c_acctbal"), 2).alias("total"))
    return reshape.pivot_wide(sums, ["c_nationkey", "lot"], "c_mktsegment", "total", SEGMENTS, prefix="seg ")


def by_flag(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(
        F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n_lines"))


BY_FLAG_SQL = ", ".join(f"sum(l_quantity) FILTER (WHERE l_returnflag = '{f}') AS \"sum_qty_{f}\", "
                        f"nullif(count(*) FILTER (WHERE l_returnflag = '{f}'), 0) AS \"n_lines_{f}\"" for f in FLAGS)


@query(f"SELECT l_orderkey, {BY_FLAG_SQL} FROM lineitem GROUP BY 1")
def pivot_wide_multi_value(spark, sf_dir):
    return reshape.pivot_wide_values(by_flag(spark, sf_dir), ["l_orderkey"], "l_returnflag", ["sum_qty", "n_lines"], FLAGS)


TYPE_GROUPS = {"big": ["MEDIUM", "LARGE"], "special": ["PROMO", "ECONOMY"], "plain": ["STANDARD"]}


@query("""WITH t AS (SELECT l_orderkey, p_type, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
          SELECT l_orderkey, """ + ", ".join(
    f"string_agg(q, ',' ORDER BY p_type) FILTER (WHERE p_type IN ({', '.join(repr(t) for t in raw)})) AS q_{name}"
    for name, raw in TYPE_GROUPS.items()) + " FROM t GROUP BY 1")
def pivot_wide_list_cells(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), col("l_partkey") == col("p_partkey"))
    sums = lines.groupBy("l_orderkey", "p_type").agg(F.sum("l_quantity").cast("long").alias("q"))
    wide = reshape.pivot_wide_lists(sums, ["l_orderkey"], "p_type", TYPE_GROUPS, ["q"], others="drop")
    return wide.select("l_orderkey", *[F.array_join(col(f"q_{n}").cast("array<string>"), ",").alias(f"q_{n}") for n in TYPE_GROUPS])


@query("""SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_orderkey END) AS name_form1, max(CASE WHEN rn = 2 THEN o_orderkey END) AS name_form2,
                 max(CASE WHEN rn = 3 THEN o_orderkey END) AS name_form3
          FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
          WHERE rn <= 3 GROUP BY 1""")
def pivot_wide_ranked_names(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    ranked = top_rows(orders, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 3)
    return reshape.pivot_wide(ranked, ["o_custkey"], "rank", "o_orderkey", [1, 2, 3], prefix="name_form")


@query("""SELECT c_custkey, 'c_acctbal' AS name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS value FROM customer
          UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer""")
def pivot_long_prefix(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(col("c_acctbal") > 0, col("c_acctbal")).alias("c_acctbal"), col("c_nationkey").cast("double").alias("c_nationkey"))
    columns = [c for c in customers.columns if c.startswith("c_") and c != "c_custkey"]
    return reshape.pivot_long(customers, columns, "name", "value")


@query(" UNION ALL ".join(
    f"SELECT l_orderkey, '{f}' AS flag, sum(l_quantity) FILTER (WHERE l_returnflag = '{f}') AS sum_qty, "
    f"nullif(count(*) FILTER (WHERE l_returnflag = '{f}'), 0) AS n_lines FROM lineitem GROUP BY 1" for f in FLAGS))
def pivot_long_multi_value(spark, sf_dir):
    wide = reshape.pivot_wide_values(by_flag(spark, sf_dir), ["l_orderkey"], "l_returnflag", ["sum_qty", "n_lines"], FLAGS)
    return reshape.pivot_long_values(wide, [c for c in wide.columns if c != "l_orderkey"], "flag")


@query("SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'NA') || '-' || o_orderpriority AS label FROM orders")
def unite_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(col("o_orderstatus"), F.lit("P")).alias("status"), "o_orderpriority")
    return reshape.unite(orders, "label", ["status", "o_orderpriority"])


@query("""SELECT o_orderkey, i, o_custkey + i AS a, o_custkey AS b, CASE WHEN o_orderstatus = 'F' THEN i END AS c
          FROM orders, range(1, 5) r(i) WHERE i <= o_orderkey % 5""")
def unnest_parallel(spark, sf_dir):
    n = (col("o_orderkey") % 5).cast("int")
    upto = F.when(n > 0, F.sequence(F.lit(1), n))
    lists = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.transform(upto, lambda i: col("o_custkey") + i).alias("a"),
        F.when(n > 0, F.array("o_custkey")).alias("b"),
        F.when(col("o_orderstatus") == "F", F.coalesce(upto, F.array().cast("array<int>"))).cast("array<bigint>").alias("c"))
    return reshape.unnest_parallel(lists, ["a", "b", "c"], place="i").withColumn("i", col("i").cast("long"))


@query("""WITH lines AS (
    SELECT o_custkey, o_orderpriority AS label, min(o_orderkey) AS n, CASE WHEN count(*) > 1 THEN max(o_orderkey) END AS m FROM orders GROUP BY 1, 2),
  numbered AS (
    SELECT *, CASE WHEN label IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'early' ELSE 'late' END AS kind,
           row_number() OVER (PARTITION BY o_custkey, CASE WHEN label IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 ELSE 2 END ORDER BY label) AS slot FROM lines)
  SELECT o_custkey, any_value(n) FILTER (WHERE kind = 'early') AS n_early, any_value(n) FILTER (WHERE kind = 'late') AS n_late,
         any_value(m) FILTER (WHERE kind = 'early') AS m_early, any_value(m) FILTER (WHERE kind = 'late') AS m_late,
         any_value(label) FILTER (WHERE kind = 'early') AS early, any_value(label) FILTER (WHERE kind = 'late') AS late
  FROM numbered GROUP BY o_custkey, slot""")
def unnest_labelled(spark, sf_dir):
    """Three labels against two in a row, and a measure that is missing for some labels."""
    lines = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.min("o_orderkey").alias("n"), F.when(F.count(F.lit(1)) > 1, F.max("o_orderkey")).alias("m"))
    groups = {"early": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "late": ["4-NOT SPECIFIED", "5-LOW"]}
    wide = reshape.pivot_wide_labelled(lines, ["o_custkey"], "o_orderpriority", groups, ["n", "m"])
    return reshape.unnest_labelled(wide, {g: [f"n_{g}", f"m_{g}"] for g in groups})


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity || ',' || (l_quantity + 1) AS quantities, CAST(NULL AS VARCHAR) AS missing
          FROM lineitem""")
def nested_field_extract(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array(
        F.struct(col("l_quantity").alias("q"), col("l_tax").alias("t")),
        F.struct((col("l_quantity") + 1).alias("q"), col("l_tax").alias("t"))).alias("events"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey",
                        F.array_join(reshape.nested_field(lines, "events", "q").cast("array<string>"), ",").alias("quantities"),
                        reshape.nested_field(lines, "events", "no_such_field").cast("string").alias("missing"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity + l_linenumber) / 2, 4) AS mean FROM lineitem
          WHERE l_returnflag <> 'N' AND l_linestatus <> 'F'""")
def nested_list_mean(spark, sf_dir):
    numbers = (F.when(col("l_returnflag") == "N", F.array().cast("array<double>"))
               .when(col("l_linestatus") == "F", F.array(col("l_quantity"), F.lit(None)))
               .otherwise(F.array("l_quantity", "l_linenumber")))
    means = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(list_mean(numbers), 4).alias("mean"))
    return means.filter(col("mean").isNotNull())

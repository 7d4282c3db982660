"""Projection, renaming and column arithmetic."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..names import col
from ..operators import columns as C
from ..operators.reshape import pivot_count
from .registry import query, table

STATUSES = ["F", "O", "P"]


def orders_by_month(spark, sf_dir):
    """Order totals by customer, one column per month, NULL where there were none."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(*[
        F.round(F.sum(F.when(F.month("o_orderdate") == m, col("o_totalprice"))), 2).alias(f"m{m}") for m in range(1, 13)])


MONTHS_SQL = "months AS (SELECT o_custkey, " + ", ".join(
    f"round(sum(CASE WHEN month(o_orderdate) = {m} THEN o_totalprice END), 2) AS m{m}" for m in range(1, 13)
) + " FROM orders GROUP BY 1)"


@query("SELECT p_partkey, p_brand, p_size FROM part")
def sel_columns(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size").drop("p_name")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, "
       "l_linestatus, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def sel_prefix(spark, sf_dir):
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), col("l_partkey") == col("p_partkey"))
    kept = joined.select(*C.names_with_prefix(joined, "l_"), "p_name")
    return C.drop_prefixes(kept, "l_ship", "l_disc", "l_tax")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def sel_regex(spark, sf_dir):
    return C.select_matching(table(spark, sf_dir, "orders"), "^o_order(?!date)")


@query("SELECT o_orderstatus, o_orderkey, o_custkey FROM orders")
def sel_front(spark, sf_dir):
    return C.to_front(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderstatus")


@query("SELECT c_custkey AS klant, c_name AS naam, c_nationkey FROM customer")
def ren_columns(spark, sf_dir):
    return (table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "klant", "c_name": "naam"})
            .select("klant", "naam", "c_nationkey"))


@query("SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier")
def ren_strip_prefix(spark, sf_dir):
    return C.strip_prefix(table(spark, sf_dir, "supplier"), "s_")


@query("SELECT s_suppkey AS unl_id, s_name AS unl_name, s_nationkey, s_acctbal AS unl_balance FROM supplier")
def ren_from_documentation(spark, sf_dir):
    naming = spark.createDataFrame([("s_suppkey", "unl_id"), ("s_name", "unl_name"), ("s_acctbal", "unl_balance"),
                                    ("other", "unl_other")], "`from` string, `to` string")
    return C.rename_by_documentation(table(spark, sf_dir, "supplier"), naming)


@query("""SELECT c_custkey AS "sleutel", c_nationkey AS "sleutel.1", c_name AS "X2.naam", c_acctbal AS "saldo..eur."
          FROM customer""")
def ren_repair_names(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_acctbal")
    return C.with_repaired_names(customer.toDF("sleutel", "sleutel", "2 naam", "saldo (eur)"))


@query("SELECT c_custkey, 0 AS unl_a, 0 AS unl_b FROM customer")
def mut_constant_columns(spark, sf_dir):
    return C.add_constants(table(spark, sf_dir, "customer").select("c_custkey"), ["unl_a", "unl_b"])


@query("WITH " + MONTHS_SQL + " SELECT o_custkey, " + ", ".join(f"coalesce(m{m}, 0) AS m{m}" for m in range(1, 13))
       + " FROM months")
def mut_fill_na_by_type(spark, sf_dir):
    return C.zero_missing_numbers(orders_by_month(spark, sf_dir), doubles_only=True)


@query("""SELECT o_custkey, coalesce("F", 0) AS "F", coalesce("O", 0) AS "O", "P",
                 coalesce("F", 0) + coalesce("O", 0) AS total
          FROM (SELECT o_custkey, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0) AS "F",
                       round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 0) AS "O",
                       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 0) AS "P"
                FROM orders GROUP BY 1)""")
def mut_fill_na_named(spark, sf_dir):
    wide = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(*[
        F.round(F.sum(F.when(col("o_orderstatus") == s, col("o_totalprice"))), 0).alias(s) for s in STATUSES])
    return C.zero_missing(wide, ["F", "O"]).withColumn("total", C.sum_of(["F", "O"]))


@query("WITH " + MONTHS_SQL + " SELECT o_custkey, round(" + " + ".join(f"coalesce(m{m}, 0)" for m in range(1, 13))
       + ", 2) AS total FROM months")
def row_total(spark, sf_dir):
    months = orders_by_month(spark, sf_dir)
    return months.select("o_custkey", F.round(C.total_of([c for c in months.columns if c != "o_custkey"]), 2).alias("total"))


@query("WITH " + MONTHS_SQL + " SELECT o_custkey, round((" + " + ".join(f"coalesce(m{m}, 0)" for m in range(1, 13))
       + ") / 12, 4) AS mean_all, round((" + " + ".join(f"m{m}" for m in range(1, 7))
       + ") / 6, 4) AS mean_first_half FROM months")
def row_mean(spark, sf_dir):
    months = orders_by_month(spark, sf_dir)
    names = [f"m{m}" for m in range(1, 13)]
    filled = C.zero_missing(months, names)
    filled = filled.withColumn("mean_all", F.round(C.mean_of(names), 4)).select("o_custkey", "mean_all")
    half = months.select("o_custkey", F.round(C.mean_of(names[:6]), 4).alias("mean_first_half"))
    return filled.join(half, "o_custkey")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS jaar,
                 count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
                 count(*) FILTER (WHERE o_orderstatus = 'P') AS "P", count(*) AS "all",
                 count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS open_and_done
          FROM orders GROUP BY 1""")
def sum_named_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("jaar", F.year("o_orderdate"))
    return pivot_count(orders, ["jaar"], col("o_orderstatus"), STATUSES, "all").withColumn(
        "open_and_done", C.sum_of(["F", "O"]))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
                 CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_extendedprice END AS picked FROM lineitem""")
def pick_column_by_value(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    picked = C.pick_by_name("l_returnflag", {"A": "l_quantity", "N": "l_extendedprice", "R": "no_such_column"}, lines.columns)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", picked.alias("picked"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN NULL ELSE 'naam' END AS naam
          FROM orders""")
def clear_if_all_empty(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    low, done = col("o_orderpriority") == "5-LOW", col("o_orderstatus") == "F"
    value = F.array(col("o_custkey"))
    lists = orders.select("o_orderkey", F.lit("naam").alias("naam"), F.when(~low, value).alias("a"),
                          F.when(done, F.array().cast("array<bigint>")).otherwise(value).alias("b"),
                          F.when(~low & ~done, value).alias("c"), F.filter(value, lambda x: ~done).alias("d"))
    return C.clear_if_all_empty(lists, "naam", ["a", "b", "c", "d"]).select("o_orderkey", "naam")


@query("""SELECT 'never' AS "column", false AS has_value UNION ALL
          SELECT 'o_custkey', count(o_custkey) > 0 FROM orders UNION ALL
          SELECT 'rare', count(*) FILTER (WHERE o_totalprice > 400000) > 0 FROM orders""")
def column_has_value(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(col("o_totalprice") > 400000, col("o_orderkey")).alias("rare"),
        F.when(col("o_totalprice") < 0, col("o_orderkey")).alias("never"))
    return C.columns_with_values(orders)

"""Joins and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import key_text
from ..names import col
from ..operators import contains, joins
from .registry import query, table


@query("""SELECT o_orderkey, c_name FROM
            (SELECT o_orderkey, nullif(o_custkey % 50, 7) AS a, nullif(o_orderstatus, 'P') AS b FROM orders) o
          LEFT JOIN (SELECT nullif(c_custkey % 50, 7) AS x, CASE WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'O' END AS y,
                            min(c_name) AS c_name FROM customer GROUP BY 1, 2) c
          ON a IS NOT DISTINCT FROM x AND b IS NOT DISTINCT FROM y""")
def join_left_renamed_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(col("o_custkey") % 50, F.lit(7)).alias("a"),
        F.nullif(col("o_orderstatus"), F.lit("P")).alias("b"))
    third = col("c_custkey") % 3
    names = table(spark, sf_dir, "customer").groupBy(
        F.nullif(col("c_custkey") % 50, F.lit(7)).alias("x"),
        F.when(third == 0, "F").when(third == 1, "O").alias("y")).agg(F.min("c_name").alias("c_name"))
    return joins.left_join(orders, names, [("a", "x"), ("b", "y")]).select("o_orderkey", "c_name")


@query("""SELECT c_custkey, coalesce(s.bal, c.bal) AS right_first, coalesce(c.bal, s.bal) AS left_first FROM
            (SELECT c_custkey, CASE WHEN c_acctbal >= 1000 THEN c_acctbal END AS bal FROM customer) c
          LEFT JOIN (SELECT s_suppkey, CASE WHEN s_acctbal >= 1000 THEN s_acctbal END AS bal FROM supplier) s
          ON c_custkey = s_suppkey""")
def join_left_coalesce(spark, sf_dir):
    def balances(name, key, balance):
        known = F.when(col(balance) >= 1000, col(balance))
        return table(spark, sf_dir, name).select(key, known.alias("right_first"), known.alias("left_first"))
    customers, suppliers = balances("customer", "c_custkey", "c_acctbal"), balances("supplier", "s_suppkey", "s_acctbal")
    on = ("c_custkey", "s_suppkey")
    right = joins.left_join_coalesce(customers.drop("left_first"), suppliers.drop("left_first"), on, ["right_first"], "right")
    left = joins.left_join_coalesce(customers.drop("right_first"), suppliers.drop("right_first"), on, ["left_first"], "left")
    return right.join(left, "c_custkey")


@query("""SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
          LEFT JOIN nation ON c_nationkey = n_nationkey""")
def join_checked_cardinality(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = joins.left_join_checked(orders, customers, ("o_custkey", "c_custkey"), "many-to-one")
    named = joins.left_join_checked(named, nations, ("c_nationkey", "n_nationkey"), "many-to-one")
    # the same customers again, one row on either side
    again = joins.left_join_checked(customers.select("c_custkey"), customers.select("c_custkey", col("c_name").alias("name_again")),
                                    "c_custkey", "one-to-one")
    return joins.left_join(named, again, ("o_custkey", "c_custkey")).select("o_orderkey", "c_name", "n_name")


@query("""SELECT c_custkey, n_name AS region_label, c_nationkey FROM customer
          LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey""")
def join_mapping_translate(spark, sf_dir):
    mapping = (table(spark, sf_dir, "nation").filter(col("n_regionkey") != 2)
               .select(col("n_nationkey").alias("c_nationkey"), col("n_name").alias("region_label")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.translate(customers, mapping, "c_nationkey", "region_label", keep_original=True)


@query("""SELECT c_custkey, CASE WHEN n_nationkey IS NOT NULL THEN 'nations(' || n_name || ')' END AS "nation@odata.bind"
          FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey""")
def join_lookup_reference(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").filter(col("n_regionkey") != 1)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.lookup_reference(customers, nations, ("c_nationkey", "n_nationkey"), "n_name", "nations",
                                  "nation@odata.bind").drop("c_nationkey")


@query("""WITH asked AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'nation_' || c_nationkey
                                    WHEN c_custkey % 3 = 1 THEN CAST(c_nationkey AS VARCHAR) ELSE 'x' END AS asked FROM customer)
          SELECT c_custkey, CASE WHEN n.id IS NOT NULL THEN 'nations(' || n.id || ')' END AS bind FROM asked
          LEFT JOIN (SELECT k, min(n_nationkey) AS id FROM (SELECT lower(n_name) AS k, n_nationkey FROM nation
                       UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_nationkey FROM nation) GROUP BY 1) n ON asked = n.k""")
def join_lookup_either_key(spark, sf_dir):
    third, nation = col("c_custkey") % 3, col("c_nationkey").cast("string")
    asked = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(third == 0, F.concat(F.lit("nation_"), nation)).when(third == 1, nation)
        .otherwise(F.lit("x")).alias("asked"))
    return joins.lookup_either_key(asked, table(spark, sf_dir, "nation"), "asked",
                                   [F.lower("n_name"), key_text(col("n_nationkey"))], "n_nationkey", "nations", "bind").drop("asked")


@query("""SELECT c_custkey, 'orders(' || o_orderkey || ')' AS first_order FROM customer
          LEFT JOIN (SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders
                     WHERE year(o_orderdate) = 1997 GROUP BY 1) ON c_custkey = o_custkey""")
def join_lookup_first_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("jaar", F.year("o_orderdate"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.lit(1997).alias("asked"))
    return joins.lookup_reference(customers, orders, [("c_custkey", "o_custkey"), ("asked", "jaar")], "o_orderkey", "orders",
                                  "first_order", order=["o_orderdate", "o_orderkey"]).drop("asked")


@query("""WITH cal AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, min(o_orderdate)::DATE AS d FROM orders GROUP BY 1, 2)
          SELECT o_orderkey, a.d AS start_date, b.d AS end_date FROM
            (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, month(o_orderdate) + o_orderkey % 3 - 1 AS e FROM orders) o
          LEFT JOIN cal a ON o.y = a.y AND o.m = a.m LEFT JOIN cal b ON o.y = b.y AND o.e = b.m""")
def join_two_roles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    calendar = orders.groupBy(col("y").alias("cal_year"), col("m").alias("cal_month")).agg(
        F.to_date(F.min("o_orderdate")).alias("d"))
    spans = orders.select("o_orderkey", "y", "m", (col("m") + col("o_orderkey") % 3 - 1).alias("e"))
    started = joins.left_join(spans, calendar.withColumnRenamed("d", "start_date"), [("y", "cal_year"), ("m", "cal_month")])
    ended = joins.left_join(started, calendar.withColumnRenamed("d", "end_date"), [("y", "cal_year"), ("e", "cal_month")])
    return ended.select("o_orderkey", "start_date", "end_date")


@query("""WITH words(w) AS (SELECT DISTINCT split_part(p_name, ' ', 2) FROM part),
          named AS (SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN p_name END AS name FROM part)
          SELECT p_partkey, coalesce(min(w), name) AS canonical FROM named LEFT JOIN words ON contains(name, w)
          GROUP BY p_partkey, name""")
def join_contains_canonicalise(spark, sf_dir):
    """Some names are missing, and those stay so."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(col("p_size") % 5 > 0, col("p_name")).alias("name"))
    words = parts.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"))
    return contains.replace_by_contained(parts, "name", words, "w", "canonical").select("p_partkey", "canonical")


@query("""WITH ours AS (SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 0) AS total FROM orders GROUP BY 1),
          theirs AS (SELECT o_orderstatus, count(*) AS n_expected, round(sum(o_totalprice), 0) AS total_expected FROM orders
                     WHERE o_orderpriority <> '5-LOW' OR o_orderstatus = 'F' GROUP BY 1)
          SELECT o_orderstatus, n, n_expected, n = n_expected AS n_equal, n - n_expected AS n_difference,
                 total = total_expected AS total_equal, total - total_expected AS total_difference
          FROM ours LEFT JOIN theirs USING (o_orderstatus)""")
def join_reconcile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")

    def figures(rows, n, total):
        return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias(n), F.round(F.sum("o_totalprice"), 0).alias(total))
    theirs = figures(orders.filter((col("o_orderpriority") != "5-LOW") | (col("o_orderstatus") == "F")), "n_expected", "total_expected")
    compared = joins.reconcile(figures(orders, "n", "total"), theirs, "o_orderstatus",
                               [("n", "n_expected"), ("total", "total_expected")])
    return compared.drop("total", "total_expected")

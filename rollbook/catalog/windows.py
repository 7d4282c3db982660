"""Order-dependent operators, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..names import col
from ..operators import tables, windows
from .registry import query, table


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders")
def win_row_number_global(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return windows.number_rows(orders, [], ["o_orderdate", "o_orderkey"], "rn").drop("o_orderdate")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY p DESC NULLS LAST, o_orderkey) AS rn
          FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS p FROM orders)""")
def win_rank_in_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(col("o_orderstatus") != "P", col("o_totalprice")).alias("p"))
    return windows.number_rows(orders, ["o_custkey"], ["-p", "o_orderkey"], "rn").select("o_orderkey", "rn")


@query("""SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def win_top_k(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_rows(orders, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 3).drop("o_totalprice")


YEARLY_SQL = """yearly AS (SELECT o_custkey, year(o_orderdate) AS jaar, CASE WHEN count(*) > 1 THEN round(sum(o_totalprice), 2) END AS total
                FROM orders GROUP BY 1, 2)"""


def yearly(spark, sf_dir):
    """Totals by customer and year, missing where there was a single order."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("jaar")).agg(
        F.when(F.count(F.lit(1)) > 1, F.round(F.sum("o_totalprice"), 2)).alias("total"))


@query("WITH " + YEARLY_SQL + """ SELECT o_custkey, CAST(jaar AS INTEGER) AS jaar,
            coalesce(total, lag(total) OVER (PARTITION BY o_custkey ORDER BY jaar)) AS total FROM yearly""")
def win_lag_fill(spark, sf_dir):
    return windows.fill_from_previous(yearly(spark, sf_dir), ["o_custkey"], ["jaar"], ["total"])


@query("""SELECT event_id, coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v,
                 coalesce(t, last_value(t IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   first_value(t IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS t
          FROM (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('click', 'view') THEN value END AS v,
                       CASE WHEN event_type = 'purchase' THEN event_type || event_id END AS t FROM events)""")
def win_fill_down_up(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(col("event_type").isin("click", "view"), col("value")).alias("v"),
        F.when(col("event_type") == "purchase", F.concat("event_type", "event_id")).alias("t"))
    return windows.fill_down_up(events, ["user_id"], ["ts", "event_id"], ["v", "t"]).select("event_id", "v", "t")


@query("""SELECT event_id, coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS v
          FROM (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS v FROM events)""")
def win_first_non_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(col("event_type") == "purchase", col("value")).alias("v"))
    return windows.fill_first(events, ["user_id"], ["ts", "event_id"], ["v"]).select("event_id", "v")


@query("""SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS group_total,
                 round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share FROM orders""")
def win_group_total(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    totals = windows.attach(orders, ["o_custkey"], F.sum("o_totalprice").alias("t"))
    return totals.select("o_orderkey", F.round("t", 2).alias("group_total"),
                         F.round(col("o_totalprice") / col("t"), 6).alias("share"))


@query("SELECT o_orderkey, CAST(max(year(o_orderdate)) OVER (PARTITION BY nullif(o_orderstatus, 'P'), o_custkey) AS INTEGER) AS last_year FROM orders")
def win_group_max(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.nullif(col("o_orderstatus"), F.lit("P")).alias("status"), F.year("o_orderdate").alias("jaar"))
    return windows.attach(orders, ["status", "o_custkey"], F.max("jaar").alias("last_year")).select("o_orderkey", "last_year")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (
            PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def win_keep_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("jaar", F.year("o_orderdate"))
    return windows.keep_first(orders, ["o_custkey", "jaar"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer ORDER BY segment NULLS LAST, c_custkey")
def ord_ascending(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.nullif(col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return tables.sort_rows(customers, ["segment", "c_custkey"])


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC NULLS LAST, o_custkey")
def ord_descending(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return tables.sort_rows(counts, ["-n", "o_custkey"])


@query("SELECT o_custkey, o_totalprice, o_orderkey FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def ord_within_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    return tables.sort_rows(orders, ["o_custkey", "-o_totalprice", "o_orderkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def lim_first(spark, sf_dir):
    return tables.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                             ["-o_totalprice", "o_orderkey"], 5)


@query("SELECT DISTINCT c_nationkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def set_distinct(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_nationkey", F.nullif(col("c_mktsegment"), F.lit("BUILDING")).alias("segment")).distinct()


@query("""SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 0 AS source FROM customer
          UNION ALL SELECT s_name, s_acctbal, NULL, 1 FROM supplier""")
def set_union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        col("c_name").alias("name"), col("c_acctbal").alias("balance"), col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(col("s_acctbal").alias("balance"), col("s_name").alias("name"))
    return tables.bind_rows(customers, suppliers, source="source")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def set_union_many(spark, sf_dir):
    from ..session import scratch_path
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    base = scratch_path(spark, "many")
    paths = []
    for status in ("F", "O", "P"):
        paths.append(f"{base}/orders {status}")
        orders.filter(col("o_orderstatus") == status).drop("o_orderstatus").write.parquet(paths[-1])
    return spark.read.parquet(*paths)

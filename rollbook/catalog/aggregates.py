"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import list_sum
from ..functions.conditions import count_distinct_with_missing, strict_sum, sum_present
from ..names import col
from ..operators import tables
from ..operators.windows import collapse_text
from ..plans.timetable import unpack_activities
from .registry import query, table
from .sources import ACTIVITIES_SQL, activities_from_orders


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS jaar, nullif(o_orderstatus, 'P') AS status, o_orderpriority, count(*) AS n
          FROM orders GROUP BY 1, 2, 3""")
def agg_count(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .groupBy(F.year("o_orderdate").alias("jaar"), F.nullif(col("o_orderstatus"), F.lit("P")).alias("status"),
                     "o_orderpriority").agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT l_orderkey, CASE WHEN count(*) = count(nullif(l_quantity, 50)) THEN sum(nullif(l_quantity, 50)) END AS total
          FROM lineitem GROUP BY 1""")
def agg_sum_strict(spark, sf_dir):
    quantity = F.nullif(col("l_quantity"), F.lit(50.0))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(strict_sum(quantity).alias("total"))


@query("""SELECT o_custkey, coalesce(round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2), 0) AS total
          FROM orders GROUP BY 1""")
def agg_sum_skip_na(spark, sf_dir):
    done = F.when(col("o_orderstatus") == "F", col("o_totalprice"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(sum_present(done), 2).alias("total"))


@query("SELECT o_custkey, min(o_orderkey) AS first_key FROM orders GROUP BY 1")
def agg_min(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_key"))


@query("SELECT o_custkey, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders GROUP BY 1")
def agg_max(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.year("o_orderdate")).alias("last_year"))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS jaar,
                 CAST(count(DISTINCT c) + max(CASE WHEN c IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS customers
          FROM (SELECT o_orderdate, nullif(o_custkey, o_orderkey % 1500) AS c FROM orders) GROUP BY 1""")
def agg_count_distinct(spark, sf_dir):
    customer = F.nullif(col("o_custkey"), col("o_orderkey") % 1500)
    return (table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("jaar"), customer.alias("c"))
            .groupBy("jaar").agg(count_distinct_with_missing(col("c")).alias("customers")))


@query("""SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
                 count(*) FILTER (WHERE l_linestatus = 'O') AS open, count(nullif(l_tax, 0)) AS taxed
          FROM lineitem GROUP BY 1""")
def agg_count_if(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(col("l_returnflag") == "R").alias("returned"), F.count_if(col("l_linestatus") == "O").alias("open"),
        F.count(F.nullif(col("l_tax"), F.lit(0.0))).alias("taxed"))


@query("""SELECT o_custkey, (rn - 1) // 100000 AS part,
                 string_agg(coalesce(nullif(o_orderstatus, 'P'), 'NA'), ', ' ORDER BY rn) AS statuses
          FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
          GROUP BY 1, 2""")
def agg_string_collapse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("status", F.nullif(col("o_orderstatus"), F.lit("P")))
    return collapse_text(orders, ["o_custkey"], "status", ["o_orderdate", "o_orderkey"], "statuses")


@query("""SELECT l_orderkey, count(DISTINCT v) AS n_distinct, count(v) AS n_values
          FROM (SELECT l_orderkey, unnest([weekofyear(l_shipdate), nullif(l_linenumber, 3)]) AS v FROM lineitem) GROUP BY 1""")
def agg_list_histogram(spark, sf_dir):
    lists = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.array(F.weekofyear("l_shipdate"), F.nullif(col("l_linenumber"), F.lit(3))).alias("weeks"))
    return tables.list_histogram(lists, ["l_orderkey"], "weeks")


@query("SELECT l_orderkey, sum(l_quantity + l_linenumber) AS total FROM lineitem GROUP BY 1")
def agg_list_sum(spark, sf_dir):
    lists = table(spark, sf_dir, "lineitem").select("l_orderkey", F.array("l_quantity", "l_linenumber").alias("numbers"))
    return lists.groupBy("l_orderkey").agg(F.sum(list_sum(col("numbers"))).alias("total"))


def workload_sql(variant: str) -> str:
    """Load per module, type and year from the derived activities."""
    load, hours = {
        "new": ("sum(mins) / (count(DISTINCT week) * n_groups)", "sum(mins) / 60"),
        "old": ("any_value(mean_mean)", "count(week) * any_value(mean_mean) / 60"),
    }[variant]
    return f"""SELECT module AS ter_module_code, type AS ter_type, jaar || '-' || (jaar + 1) AS unl_jaar,
         n_groups, count(DISTINCT week) AS n_weeks, round({load}, 6) AS minutes_per_group_week,
         round({hours}, 6) AS contact_hours
  FROM acts JOIN events_of USING (k) JOIN (
      SELECT module, type, jaar, count(DISTINCT grp) + max(CASE WHEN grp IS NULL THEN 1 ELSE 0 END) AS n_groups, avg(m) AS mean_mean
      FROM (SELECT *, (SELECT avg(mins) FROM events_of e WHERE e.k = a.k) AS m FROM acts a WHERE kept = 1 AND n_events > 0)
      GROUP BY ALL) USING (module, type, jaar)
  WHERE kept = 1 GROUP BY module, type, jaar, n_groups"""


@query("WITH " + ACTIVITIES_SQL + f"""SELECT 'new' AS variant, n.* FROM ({workload_sql('new')}) n
       UNION ALL SELECT 'old', o.* FROM ({workload_sql('old')}) o""")
def agg_workload_ratio(spark, sf_dir):
    from ..sources.nested import keep_activity_files
    activities = unpack_activities(keep_activity_files(activities_from_orders(table(spark, sf_dir, "orders"))))

    def load(variant):
        rows = tables.workload(activities, ["ter_module_code", "ter_type", "unl_jaar"], "ter_student_groups", "weeks",
                               "minutes", variant)
        return rows.withColumns({"variant": F.lit(variant),
                                 "minutes_per_group_week": F.round("minutes_per_group_week", 6),
                                 "contact_hours": F.round("contact_hours", 6)})
    return load("new").unionByName(load("old"))


@query("SELECT l_suppkey, round(avg(l_extendedprice / l_quantity), 4) AS mean_price FROM lineitem GROUP BY 1")
def agg_mean(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.avg(col("l_extendedprice") / col("l_quantity")), 4).alias("mean_price"))


@query("SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS percent FROM events GROUP BY 1")
def agg_frequency_table(spark, sf_dir):
    return tables.sort_rows(tables.frequency_table(table(spark, sf_dir, "events"), "event_type"), ["-n", "event_type"])


@query("SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def agg_duplicate_keys(spark, sf_dir):
    return tables.repeated_keys(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


@query("SELECT lang, bool_or(toxic = 1) AS any_toxic, bool_or(quality = 0) AS any_poor FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def agg_any(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.groupBy("lang").agg(F.bool_or(col("toxic") == 1).alias("any_toxic"), F.bool_or(col("quality") == 0).alias("any_poor"))

"""Sinks: written, read back and compared."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..names import col
from ..session import scratch_path
from ..sinks import keyed, payloads, tables
from ..sources import delimited, stages
from .registry import query, table


@query("SELECT 'parquet' AS written, * FROM supplier UNION ALL SELECT 'csv', * FROM supplier")
def sink_stage_write(spark, sf_dir):
    place = stages.Stages(scratch_path(spark, "sink"))
    supplier = table(spark, sf_dir, "supplier")
    place.write(supplier.limit(0), "suppliers", "read", formats=("parquet", "csv"))  # to be replaced
    place.write(supplier, "suppliers", "read", formats=("parquet", "csv"))
    parquet = place.read(spark, "suppliers", "prepare")
    csv = delimited.read_european_csv(spark, tables.current(spark, place.path("suppliers", "read") + ".csv"), supplier.schema)
    return parquet.withColumn("written", F.lit("parquet")).unionByName(csv.withColumn("written", F.lit("csv")))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'Error' WHEN s_suppkey % 5 = 0 THEN '400' ELSE '204' END AS status,
                 CASE WHEN s_suppkey % 7 = 0 THEN 'refused' ELSE CAST(length(s_name) AS VARCHAR) END AS content FROM supplier""")
def sink_send_rows(spark, sf_dir):
    """A sender in the task's own process that fails for some rows; the second call sends those again."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    bodies = payloads.row_payloads(rows, ["s_suppkey"], ["s_suppkey", "s_name"])

    def sender(body: str) -> tuple[int, str]:
        row = json.loads(body)
        if row["s_suppkey"] % 7 == 0:
            raise ConnectionError("refused")
        return 400 if row["s_suppkey"] % 5 == 0 else 204, str(len(row["s_name"]))

    path = scratch_path(spark, "sent")
    payloads.send_payloads(bodies, "s_suppkey", sender, path)
    return payloads.send_payloads(bodies, "s_suppkey", sender, path)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def sink_object_store(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return spark.read.parquet(tables.current(spark, tables.write_to_store(orders, scratch_path(spark, "store"), "finance", "orders")))


@query("""SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"'
            || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END
            || ',"c_nationkey":' || c_nationkey || '}' AS body FROM customer""")
def sink_row_payload(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("segment", F.nullif(col("c_mktsegment"), F.lit("BUILDING")))
    return payloads.row_payloads(customer, ["c_custkey"], ["c_custkey", "c_name", "segment", "c_nationkey"])


@query("""SELECT c_custkey, 'replaced' AS c_name FROM customer WHERE c_acctbal < 0
          UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'""")
def sink_keyed_upsert(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    old = customer.filter((col("c_acctbal") < 0) | (col("c_mktsegment") != "BUILDING")).select("c_custkey", "c_name")
    new = customer.filter(col("c_acctbal") < 0).select("c_custkey", F.lit("replaced").alias("c_name"))
    path = scratch_path(spark, "log")
    keyed.create_keyed(old, path, "c_custkey", buckets=16)
    keyed.upsert_keyed(new, path)
    return keyed.read_keyed(spark, path)

"""Sources: tables are landed as the files a source reads, then read back."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.arrays import list_sum
from ..names import col
from ..operators.reshape import nested_field
from ..session import scratch_path
from ..sources import delimited, files, nested, stages
from ..sources.splits import file_system
from .registry import query, table

ROWS_PER_FILE = 1_000_000
# a line above the data of an export: title, filter and blank lines
PREAMBLE = ["Export of the planning cube", "Filter: all", "", "a;b;c", "Selected: everything"]


def land_exports(df: DataFrame, export: str, key: str, columns: Sequence[str], preamble: int, label: str) -> str:
    """Write delimited files with lines above the data, one folder per export name, each file with
    a bounded range of keys. Returns the folder."""
    path = scratch_path(df.sparkSession, label)
    df = df.withColumn("export", F.coalesce(col(export), F.lit("")))
    df = df.withColumn("file_no", F.floor(col(key) / ROWS_PER_FILE))
    data = df.select("export", "file_no", F.lit(1).alias("kind"), col(key).alias("place"),
                     F.to_csv(F.struct(*columns)).alias("value"))
    above = df.select("export", "file_no").distinct().select(
        "export", "file_no", F.lit(0).alias("kind"),
        F.posexplode(F.array(*[F.lit(x) for x in PREAMBLE[:preamble]])).alias("place", "value"))
    lines = data.unionByName(above.withColumn("place", col("place").cast("long")))
    (lines.repartition("export", "file_no").sortWithinPartitions("export", "file_no", "kind", "place")
     .select("value", "export", "file_no").write.partitionBy("export", "file_no").text(path))
    return path


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_skip_preamble(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("name", F.lit("REPORT_PLANNING ABC 2021.csv"))
    path = land_exports(customer, "name", "c_custkey",
                        ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], 4, "preamble")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_mktsegment", T.StringType())])
    return delimited.read_csv_after(spark, path, 4, schema).drop(*delimited.SOURCE_ORDER)


YEARS = list(range(1995, 2002))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Jaar", """ + ", ".join(
    f"""CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END AS "{y}" """ for y in YEARS) + " FROM orders")
def src_csv_per_file_year_column(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "name", F.concat(F.lit("REPORT_STAFF "), F.year("o_orderdate").cast("string"), F.lit(" all.csv")))
    path = land_exports(orders, "name", "o_orderkey", ["o_orderkey", "o_totalprice"], 5, "per-year")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("Jaar_data", T.DoubleType())])
    rows = delimited.read_csv_after(spark, path, 5, schema)
    name = files.export_name(col("source_file"))
    rows = rows.withColumn("Jaar", files.name_part(name, r"\d{4}").cast("int"))
    return delimited.year_columns(rows, "Jaar", "Jaar_data", YEARS).drop(*delimited.SOURCE_ORDER)


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS "Jaar", substr(o_orderpriority, 3, 3) AS "Faculteit",
                 count(*) AS n, round(sum(o_totalprice), 2) AS total
          FROM orders GROUP BY 1, 2""")
def src_filename_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("name", F.concat(
        F.lit("REPORT_PLANNING "), F.substring("o_orderpriority", 3, 3), F.lit(" "),
        F.year("o_orderdate").cast("string"), F.lit(".csv")))
    path = land_exports(orders, "name", "o_orderkey", ["o_orderkey", "o_totalprice"], 4, "file-names")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])
    rows = delimited.read_csv_after(spark, path, 4, schema)
    name = files.export_name(col("source_file"))
    named = rows.select("o_totalprice",
                        F.regexp_substr(files.name_part(name, r"\d{4}\.csv"), F.lit(r"\d{4}")).cast("int").alias("Jaar"),
                        files.name_part(name, r"\b[A-Za-z]{3,4}\b").alias("Faculteit"))
    return named.groupBy("Jaar", "Faculteit").agg(F.count(F.lit(1)).alias("n"),
                                                  F.round(F.sum("o_totalprice"), 2).alias("total"))


ROWS_PER_ZIP, ROWS_PER_MEMBER = 100_000, 1_000


def land_zips(lines: DataFrame, key: str, header: str, label: str) -> str:
    """Write the lines, which have a `value` and an integer key, to zip files of many members, each under a header line. A
    file holds a range of keys, so that a task run again writes the same bytes. Returns the folder."""
    path = scratch_path(lines.sparkSession, label)

    def pack(batches: Iterator) -> Iterator:
        import zipfile

        import pyarrow as pa

        system, folder = file_system(path if ":" in path.split("/")[0] else "file:" + path)
        system.create_dir(folder, recursive=True)

        def members():
            for batch in batches:
                yield from zip(batch.column("archive").to_pylist(), batch.column("member").to_pylist(), batch.column("value").to_pylist())

        for archive, rows in groupby(members(), lambda r: r[0]):
            with system.open_output_stream(f"{folder}/DELIVERY 2024-01-{archive:05d}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
                for member, rows_of in groupby(rows, lambda r: r[1]):
                    with file.open(f"{member}.csv", "w") as text:
                        text.write((header + "\n").encode())
                        for _, _, value in rows_of:
                            text.write((value + "\n").encode())
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.int64())], names=["archive"])

    rows = lines.select(F.floor(col(key) / ROWS_PER_ZIP).alias("archive"), F.floor(col(key) / ROWS_PER_MEMBER).alias("member"), col(key).alias("key"), "value")
    packed = rows.repartition("archive").sortWithinPartitions("archive", "member", "key").mapInArrow(pack, "archive long")
    packed.write.format("noop").mode("overwrite").save()
    return path


@query("""SELECT c_custkey, c_name, nullif(c_nationkey, 0) AS c_nationkey,
                 CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
                 nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer""")
def src_zip_delim_na_tokens(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    words = customer.select("c_custkey", F.to_csv(F.struct(
        "c_custkey", "c_name",
        F.when(col("c_nationkey") == 0, F.lit("Niet toegewezen")).otherwise(col("c_nationkey").cast("string")).alias("n"),
        F.when(col("c_acctbal") < 0, F.lit("#")).otherwise(col("c_acctbal").cast("string")).alias("b"),
        F.when(col("c_mktsegment") == "BUILDING", F.lit("NA")).otherwise(col("c_mktsegment")).alias("s"))).alias("value"))
    path = land_zips(words, "c_custkey", "key,name,nation,balance,segment", "zips")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_mktsegment", T.StringType())])
    return delimited.read_zip_csv(spark, path, schema, na=["", "NA", "#", "Niet toegewezen"])


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01'")
def src_latest_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    base = scratch_path(spark, "snapshots")
    for day in ("1998-01-01", "2001-07-01"):
        known = orders.filter(col("o_orderdate") < F.to_timestamp_ntz(F.lit(day)))
        known.drop("o_orderdate").write.parquet(f"{base}/ledger {day.replace('-', '')}")
    return spark.read.parquet(files.latest_path(files.list_files(spark, base, "^ledger")))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_european_csv(spark, sf_dir):
    path = scratch_path(spark, "european")
    delimited.write_european_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                           T.StructField("s_acctbal", T.DoubleType())])
    return delimited.read_european_csv(spark, path, schema)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_stage_read(spark, sf_dir):
    place = stages.Stages(scratch_path(spark, "stages"))
    place.write(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), "customers", "prepare")
    return place.read(spark, "customers", "send")


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def src_parquet_pruned(spark, sf_dir):
    return stages.read_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_returnflag"])


# Activities derived from orders, row by row: a module per customer, a year and type per order,
# and 0 to 3 weekly events.
RAW_TYPES = ["Hoorcollege", "Lecture", "Werkcollege", "Instructiecollege", "Werkgroep", "Practicum", "training",
             "Excursie", "Symposium", "Studiegroep", "Tentamen digitaal", "Overig"]


def activities_from_orders(orders: DataFrame) -> DataFrame:
    key = col("o_orderkey")
    types = F.array(*[F.lit(t) for t in RAW_TYPES])
    events = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.when(
        i <= key % 4, F.struct(((key * i * i) % 52 + 1).cast("int").alias("week"),
                               (F.lit(45.0) + 15 * ((key + i) % 5)).alias("activityDurationMins"))))
    return orders.select(
        F.concat(F.lit("raw/activities_"), (2021 + key % 3).cast("string"),
                 F.when(col("o_orderstatus") == "P", F.lit(".csv")).otherwise(F.lit(".rds"))).alias("ter_source_file"),
        F.concat(F.lit("V"), col("o_custkey").cast("string")).alias("ter_module_code"),
        F.element_at(types, (F.floor(key / 3) % len(RAW_TYPES) + 1).cast("int")).alias("ter_type"),
        F.when(col("o_orderpriority") != "5-LOW", F.array(col("o_orderpriority"))).alias("ter_student_groups"),
        F.array_compact(events).alias("ter_events"), key.alias("source_order"))


ACTIVITIES_SQL = """acts AS (
  SELECT o_orderkey AS k, 2021 + o_orderkey % 3 AS jaar,
         CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS kept,
         'V' || o_custkey AS module,
         (['Hoorcollege','Lecture','Werkcollege','Instructiecollege','Werkgroep','Practicum','training',
           'Excursie','Symposium','Studiegroep','Tentamen digitaal','Overig'])[(o_orderkey // 3) % 12 + 1] AS type,
         nullif(o_orderpriority, '5-LOW') AS grp, o_orderkey % 4 AS n_events
  FROM orders),
events_of AS (
  SELECT k, i, (k * i * i) % 52 + 1 AS week, 45.0 + 15 * ((k + i) % 5) AS mins
  FROM acts, range(1, 4) r(i) WHERE i <= n_events)"""


@query("WITH " + ACTIVITIES_SQL + """
  SELECT k AS source_order, CAST(jaar AS INTEGER) AS jaar, jaar || '-' || (jaar + 1) AS unl_jaar,
         CAST(n_events AS INTEGER) AS n_events, CAST(coalesce(sum(mins), 0) AS DOUBLE) AS minutes
  FROM acts LEFT JOIN events_of USING (k) WHERE kept = 1 GROUP BY ALL""")
def src_nested_activities(spark, sf_dir):
    path = scratch_path(spark, "activities")
    activities_from_orders(table(spark, sf_dir, "orders")).write.parquet(path)
    kept = nested.keep_activity_files(spark.read.parquet(path))
    return kept.select("source_order", "jaar", "unl_jaar", F.size("ter_events").alias("n_events"),
                       list_sum(nested_field(kept, "ter_events", "activityDurationMins")).alias("minutes"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS unl_custid, c_name AS unl_name, CAST(c_nationkey AS VARCHAR) AS _unl_nation_value,
                 dense_rank() OVER (ORDER BY c_custkey // 500) - 1 AS page,
                 CAST(row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) - 1 AS INTEGER) AS page_row FROM customer""")
def src_json_pages(spark, sf_dir):
    record = F.struct(col("c_custkey").alias("key"), F.concat(F.lit("W/"), col("c_custkey")).alias("@odata.etag"),
                      col("c_custkey").cast("string").alias("unl_custid"), col("c_name").alias("unl_name"),
                      col("c_nationkey").cast("string").alias("_unl_nation_value"), col("c_acctbal").alias("balance"))
    # customer keys are unique, so a page holds at most 500 records; the addresses are in no order
    pages = (table(spark, sf_dir, "customer").groupBy(F.floor(col("c_custkey") / 500).alias("page"))
             .agg(F.array_sort(F.collect_list(record)).alias("value")))
    following = pages.select((col("page") - 1).alias("page"), F.lit(True).alias("more"))

    def link(page):
        return F.concat(F.lit("feed?skiptoken="), F.md5(page.cast("string")))

    pages = pages.join(following, "page", "left").select("value", link(col("page")).alias("asked"),
                                                         F.when(col("more"), link(col("page") + 1)).alias("@odata.nextLink"))
    path = scratch_path(spark, "pages")
    pages.write.option("maxRecordsPerFile", 1).json(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("@odata.etag", "unl_custid", "unl_name", "_unl_nation_value", "balance")])
    return nested.read_json_pages(spark, path, schema, address="asked", place=True)

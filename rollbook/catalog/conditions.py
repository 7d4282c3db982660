"""Number, date and conditional functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A, conditions as K, numbers as N
from ..names import col
from ..operators.joins import left_join
from ..operators.windows import fill_from_previous
from .registry import query, table
from .windows import YEARLY_SQL, yearly


@query("SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) AS half FROM lineitem")
def num_round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", N.round_half_even(col("l_quantity") / 2).alias("half"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / 60, 6) AS hours FROM lineitem")
def num_unit_convert(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(N.minutes_to_hours(col("l_quantity")), 6).alias("hours"))


@query("SELECT c_custkey, CASE WHEN b < 0 THEN 0 ELSE b END AS b FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS b FROM customer)")
def num_clamp_negative(spark, sf_dir):
    balance = F.when(col("c_mktsegment") != "BUILDING", col("c_acctbal"))
    return table(spark, sf_dir, "customer").select("c_custkey", N.clamp_negative(balance).alias("b"))


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice * 2 ELSE o_totalprice END AS price FROM orders")
def num_conditional_scale(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", N.scale_where(col("o_totalprice"), F.year("o_orderdate") == 1998, 2.0).alias("price"))


@query("SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#1', '') AS INTEGER) AS number FROM part")
def num_cast_lenient(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", N.to_number(F.replace(col("p_brand"), F.lit("Brand#1"), F.lit("")), "int").alias("number"))


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS key FROM orders")
def cast_to_string(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", N.key_text(col("o_custkey").cast("double")).alias("key"))


@query("SELECT o_orderkey, CASE WHEN month(o_orderdate) = 3 THEN o_orderdate::DATE + 14 ELSE o_orderdate::DATE END AS start FROM orders")
def date_add_conditional(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", N.add_days_where(day, F.month("o_orderdate") == 3, 14).alias("start"))


DATES_SQL = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def shipped(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), col("l_orderkey") == col("o_orderkey"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round((l_shipdate::DATE - o_orderdate::DATE) / 7, 6) AS weeks " + DATES_SQL)
def date_diff_weeks(spark, sf_dir):
    return shipped(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey",
                                         F.round(N.weeks_between(F.to_date("l_shipdate"), F.to_date("o_orderdate")), 6).alias("weeks"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate::DATE - o_orderdate::DATE AS INTEGER) AS days,
                 o_orderdate::DATE + 1 AS next_day """ + DATES_SQL)
def date_diff_days(spark, sf_dir):
    return shipped(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey",
                                         N.days_between(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days"),
                                         F.date_add(F.to_date("o_orderdate"), 1).alias("next_day"))


@query("SELECT event_id, ts::DATE AS day FROM events")
def date_from_timestamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def date_format_timestamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.timestamp_text(col("ts")).alias("at"))


@query("SELECT o_orderkey, year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS academic_year FROM orders")
def date_academic_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", N.academic_year(F.year("o_orderdate")).alias("academic_year"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) - CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS jaar FROM orders""")
def date_shift_year(spark, sf_dir):
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(col("o_orderstatus") == "F", year - 1).otherwise(year).alias("jaar"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                                  WHEN o_orderpriority = '3-MEDIUM' THEN CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'medium' END
                                  WHEN o_totalprice > 300000 THEN 'large' END AS class FROM orders""")
def cond_case_when(spark, sf_dir):
    inner = K.case_when((col("o_orderstatus") == "F", F.lit("done")), default=F.lit("medium"))
    return table(spark, sf_dir, "orders").select("o_orderkey", K.case_when(
        (col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("high")), (col("o_orderpriority") == "3-MEDIUM", inner),
        (col("o_totalprice") > 300000, F.lit("large"))).alias("class"))


@query("SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' WHEN quality <> 1 THEN 'poor' END AS mark FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def cond_if_else_na(spark, sf_dir):
    docs = left_join(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", K.if_else(col("quality") == 1, F.lit("good"), F.lit("poor")).alias("mark"))


@query("SELECT d.doc_id, coalesce(quality, toxic, -1) AS q FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def cond_coalesce(spark, sf_dir):
    docs = left_join(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", F.coalesce("quality", "toxic", F.lit(-1)).alias("q"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 941790000 END AS code FROM lineitem")
def cond_recode(spark, sf_dir):
    codes = [("A", 1), ("N", 941790000), ("A", 9)]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", K.recode(col("l_returnflag"), codes).alias("code"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 941790007 WHEN '2-HIGH' THEN 941790008 END AS code FROM orders")
def cond_code_lookup(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", K.code_of(col("o_orderpriority"), {"1-URGENT": 941790007, "2-HIGH": 941790008}).alias("code"))


@query("SELECT d.doc_id, CASE WHEN quality = 1 THEN 1 WHEN quality = 0 THEN 2 END AS code FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def cond_bool_to_code(spark, sf_dir):
    docs = left_join(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", K.yes_no_code(col("quality") == 1).alias("code"))


@query("""SELECT p_partkey, CASE WHEN s IN (5, 6, 7, 8, 9, 10) THEN 'Schaal 5 t/m 10' WHEN s BETWEEN 11 AND 20 THEN 'Schaal 11 en hoger'
                                 ELSE 'Andere schalen' END AS band FROM (SELECT p_partkey, nullif(p_size, 7) AS s FROM part)""")
def cond_band(spark, sf_dir):
    scale = F.lpad(F.nullif(col("p_size"), F.lit(7)).cast("string"), 3, "0")
    bands = {"Schaal 5 t/m 10": [f"{i:03d}" for i in range(5, 11)], "Schaal 11 en hoger": [f"{i:03d}" for i in range(11, 21)]}
    return table(spark, sf_dir, "part").select("p_partkey", K.band(scale, bands, "Andere schalen").alias("band"))


@query("WITH " + YEARLY_SQL + """ SELECT o_custkey, CAST(jaar AS INTEGER) AS jaar, CASE WHEN o_custkey % 7 = 0 THEN NULL
              ELSE coalesce(total, lag(total) OVER (PARTITION BY o_custkey ORDER BY jaar), 941790006) END AS total FROM yearly""")
def cond_default_rules(spark, sf_dir):
    filled = fill_from_previous(yearly(spark, sf_dir), ["o_custkey"], ["jaar"], ["total"])
    credits = F.when(col("o_custkey") % 7 != 0, F.lit(6.0))
    return filled.withColumn("total", F.when(credits.isNotNull(), F.coalesce("total", F.lit(941790006.0))))


@query("SELECT doc_id, CASE WHEN lang IN ('fr', 'de') THEN CAST(n_chars AS VARCHAR) ELSE lang END AS label FROM documents")
def cond_fill_empty_string(spark, sf_dir):
    text = F.when(col("lang") == "fr", F.lit("")).when(col("lang") != "de", col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", K.fill_empty_text(text, col("n_chars")).alias("label"))


@query("""SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words, role = 'system' AS empty FROM conversations""")
def arr_length(spark, sf_dir):
    words = F.split("text", " ")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", A.list_length(words).alias("n_words"), A.is_empty_list(F.when(col("role") != "system", words)).alias("empty"))

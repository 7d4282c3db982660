"""Text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strings as S
from ..names import col
from .registry import query, table


@query("SELECT n_nationkey, lower(n_name) AS low, upper(lower(n_name)) AS up, c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def str_case(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), col("c_nationkey") == col("n_nationkey"))
    return nations.select("n_nationkey", F.lower("n_name").alias("low"), F.upper(F.lower("n_name")).alias("up"), "c_custkey")


@query("SELECT p_partkey, p_name AS trimmed FROM part")
def str_trim(spark, sf_dir):
    padded = F.concat(F.lit(" \t\n"), "p_name", F.lit(" \r\n "))
    return table(spark, sf_dir, "part").select("p_partkey", S.trim_all(padded).alias("trimmed"))


@query("SELECT c_custkey, substr(c_mktsegment, 1, 3) AS short FROM customer")
def str_substring(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.substring("c_mktsegment", 1, 3).alias("short"))


@query("SELECT p_partkey, nullif(regexp_extract(p_brand, '[0-9]+$'), '') AS digits, nullif(regexp_extract(p_type, 'O.*'), '') AS tail FROM part")
def str_extract(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.extract(col("p_brand"), "[0-9]+$").alias("digits"),
                                               S.extract(col("p_type"), "O.*").alias("tail"))


@query("SELECT doc_id, md5(regexp_replace(text, '[aeiou]', '$')) AS replaced FROM documents")
def str_replace_first(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(S.replace_first(col("text"), "[aeiou]", "$")).alias("replaced"))


@query("SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '', 'g')) AS replaced FROM documents")
def str_replace_all(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(S.replace_all(col("text"), "[0-9]+")).alias("replaced"))


@query("SELECT c_custkey, regexp_replace(lower(c_name), '^customer\\s*#\\s*', '') AS rest FROM customer")
def str_remove_prefix(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.remove_prefix(F.lower("c_name"), r"customer\s*#\s*").alias("rest"))


@query("SELECT doc_id, contains(text, '. A') AS found FROM documents")
def str_contains(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.contains(col("text"), F.lit(". A")).alias("found"))


@query("SELECT doc_id, md5(strip_accents(replace(text, 'ß', 'ss'))) AS plain FROM documents")
def str_to_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(S.to_ascii(col("text"))).alias("plain"))


@query("SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), 'NA') || ' - ' || p_brand || ' - ' || p_size AS label FROM part")
def str_paste(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", S.paste(F.nullif(col("p_type"), F.lit("PROMO")), col("p_brand"), col("p_size"), sep=" - ").alias("label"))


@query("SELECT doc_id, split_part(text, chr(10), 1) AS line FROM documents")
def str_split_first(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.first_line(col("text")).alias("line"))


@query("""SELECT c_custkey, CASE WHEN s = 'building' THEN 'bld' ELSE s END AS clean FROM (SELECT c_custkey, lower(c_mktsegment) AS s FROM customer)""")
def str_clean_entity_name(spark, sf_dir):
    raw = F.concat(F.when(col("c_custkey") % 2 == 0, F.lit("Inst  - ")).otherwise(F.lit(" ")), "c_mktsegment", F.lit(" "))
    return table(spark, sf_dir, "customer").select("c_custkey", S.clean_entity_name(raw, "inst", {"building": "bld"}).alias("clean"))


@query("""SELECT p_partkey, CAST(nullif(regexp_extract(p_brand, '[0-9]+'), '') AS DOUBLE) AS brand_no,
                 CASE WHEN p_size > 5 THEN CAST(p_size * 1000 + 0.5 AS DOUBLE) END AS amount FROM part""")
def str_parse_number(spark, sf_dir):
    amount = F.when(col("p_size") > 5, F.concat(F.lit("about EUR "), F.format_number(col("p_size") * 1000 + 0.5, 1), F.lit(" ex.")))
    return table(spark, sf_dir, "part").select("p_partkey", S.parse_number(col("p_brand")).alias("brand_no"),
                                               S.parse_number(F.coalesce(amount, F.lit("none"))).alias("amount"))

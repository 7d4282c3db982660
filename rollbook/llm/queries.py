"""A query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import bpe, chat, decontaminate, fingerprints, hard_negatives, jaccard, licences, lines, periodic_runs, quality, secrets, token_counts, urls
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def code_digests(codes: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Digest columns of encoded texts."""
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return codes.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"),
                        digest(F.col("decoded")).alias("decoded_sha256"), *(["token_ids"] if keep_ids else []))


@query("op1_decontamination")
def op1(spark, sf_dir):
    places = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return places.select("doc_id", "item_id", "first_word", "last_word", "distance")


@query("op2_licence_scan")
def op2(spark, sf_dir):
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


@query("op3_secret_scan")
def op3(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *[F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
                        digest(listed(base)).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op4_jaccard_join", f"""WITH RECURSIVE
  worded AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
  shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
  reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, b FROM reached JOIN links ON other = a)
  SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY 1""")
def op4(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op5_line_dedup")
def op5(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.dedup(documents, gone_col="gone").withColumn("n_gone", F.coalesce(F.size("gone"), F.lit(0)))
    return kept.select("doc_id", F.col("n_gone").cast("long").alias("n_dropped"), "text")


@query("op6_bpe_codec")
def op6(spark, sf_dir):
    return code_digests(bpe.encode(table(spark, sf_dir, "documents")))


@query("op7_quality_ranking")
def op7(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(documents, quality.learn(documents, labels))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op8_order_minhash")
def op8(spark, sf_dir):
    found = fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def _escaped_sql(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


@query("op9_chat_format", f"""WITH extra(conv_id, turn, role, text) AS (
    VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
  turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT CAST(conv_id AS BIGINT), CAST(turn AS BIGINT), role, text FROM extra)
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
         CAST(sum({len(chat.OPEN)} + length(role) + 1 + length({_escaped_sql("text")}) + {len(chat.CLOSE) + 1}) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY 1""")
def op9(spark, sf_dir):
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(text).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_conversations(rows).withColumn("turns", chat.read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform("loss", lambda s: chat.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    under = F.array_join(masked, "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), digest(said).alias("turns_sha256"),
                       F.length(under).cast("long").alias("loss_chars"), digest(under).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op10_url_filter")
def op10(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op11_hard_negatives", """WITH
  taken AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM taken a JOIN taken b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
  positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
         other_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
  QUALIFY rank <= 3""")
def op11(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    found = hard_negatives.mine(rows, anchors=F.col("vec_id") % 50 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query("op12_token_counts")
def op12(spark, sf_dir):
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op13_periodic_runs", """WITH
  hashed AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
           xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
               lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h
    FROM documents),
  placed AS (
    SELECT doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS planted, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a, h // 10 AS g FROM hashed),
  looped AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
  spread AS (
    SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN words[a + (i - a) % p + 1] ELSE words[i + 1] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM looped)),
  alike AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS stretch
    FROM spread x JOIN spread y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
  stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM alike GROUP BY doc_id, q, stretch HAVING count(*) + q >= greatest(6, 4 * q)),
  runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
  listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY doc_id),
  best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
  kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM spread ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
  SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, CAST(length AS BIGINT) AS length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
         sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
  FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op13(spark, sf_dir):
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), plant=periodic_runs.looped)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.get("runs", F.col("best"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
                        F.expr("get(runs, best).length * 1000 div get(runs, best).period").alias("exponent_milli"),
                        digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))

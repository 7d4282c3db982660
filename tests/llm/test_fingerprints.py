import hashlib

from helpers import AWKWARD, documents, empty
from pyspark.sql import functions as F

from rollbook.llm import fingerprints as fp, queries


def neighbours(rows):
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()))
    return sorted(out)


def check(got, rows):
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == neighbours(rows)


def test_neighbours_and_awkward_rows(spark):
    got = fp.compare_neighbours(documents(spark)).collect()
    check(got, AWKWARD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"]
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == "," * (fp.CELLS - 1)
    assert by_id[10]["next_fingerprint"] == by_id[1]["fingerprint"]
    assert fp.compare_neighbours(empty(spark)).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op8_order_minhash"](spark, sf).collect()
    check(got, rows)
    texts, by_id = dict(rows), {r["doc_id"]: r for r in got}
    prints = {}
    for i, r in by_id.items():
        assert prints.setdefault(texts[i], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    ids = sorted(by_id)
    for i, j in zip(ids, ids[1:]):
        a, b = by_id[i]["fingerprint"].split(","), by_id[j]["fingerprint"].split(",")
        either = [(x, y) for x, y in zip(a, b) if x or y]
        assert by_id[i]["near_next"] == (1.0 if a == b else sum(x == y for x, y in either) / len(either))
    mean = lambda c: sum(r[c] for r in got) / len(got)
    assert mean("near_edited") > mean("near_next") + 0.05


def test_order_and_repeats_count(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [(1, " ".join(words)), (2, " ".join(words[:190] + ["x"] * 10)), (3, " ".join(words[100:] + words[:100])),
             (4, "a b " * 100), (5, "a b " * 101), (6, " ".join(f"z{i}" for i in range(200)))]
    df = documents(spark, texts).select(F.lit(0).alias("p"), "doc_id", "text")
    got = fp.fingerprints(df, ["p", "doc_id"]).select("doc_id", "fingerprint")
    pairs = got.alias("a").join(got.alias("b"), F.col("a.doc_id") < F.col("b.doc_id"))
    near = {(r[0], r[1]): r[2] for r in pairs.select("a.doc_id", "b.doc_id", fp.likeness(F.col("a.fingerprint"), F.col("b.fingerprint"))).collect()}
    assert near[1, 2] > 0.7 and near[1, 6] == 0 and near[4, 5] > 0.7
    assert near[1, 3] < near[1, 2]  # the same k-mers but a few, in another order


def test_parts_follow_the_ids(spark):
    parts = fp.in_order(documents(spark, [(i * i, "x") for i in range(500)]).select(F.col("doc_id").alias("id"))).collect()
    placed = [p["part"] for p in sorted(parts)]
    assert placed == sorted(placed) and max(placed.count(p) for p in set(placed)) < 200


def test_no_python_in_the_plan(spark, plan_of):
    plan = plan_of(queries.QUERIES["op8_order_minhash"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Arrow" not in plan

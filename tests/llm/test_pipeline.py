"""The pipeline against plain versions of its stages, on documents with known faults."""

import random

import corpus_pipeline as pipeline
from helpers import documents
from pyspark.sql import functions as F
from test_jaccard import brute_force as components
from test_lines import brute_force as plain_lines

from rollbook.llm import bpe, decontaminate as dc, quality

SF = "/root/testdata/sf0.001"


def corpus():
    dice = random.Random(8)
    word = lambda: "".join(dice.choice("abcdefghijklmnoprstuvw") for _ in range(dice.randint(2, 9)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(25)) for _ in range(n))
    rows = [(i, text(3)) for i in range(12)]
    rows += [(20, rows[0][1]), (21, rows[1][1] + "\n" + text(1)), (22, None), (23, "")]
    return rows


def test_lines_then_copies_then_benchmark(spark):
    rows = corpus()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rows += [(30, "some words before " + items[0]["text"] + " and after"), (31, items[1]["text"].upper())]
    docs = documents(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    columns = docs.columns
    lined = pipeline.distinct_lines(spark, docs, SF)
    expected = {i: t for i, t in plain_lines(rows) if not (t == "" and dict(rows)[i])}
    got = {r["doc_id"]: r for r in lined.collect()}
    assert lined.columns == columns and {i: r["text"] for i, r in got.items()} == expected
    assert 20 not in got and all(r["n_chars"] == len(r["text"]) for r in got.values() if r["text"] is not None)
    # each stage works on its own input, so the copies are still there for the next one
    single = pipeline.one_of_each(spark, docs, SF)
    least = {i for i, _, c in components(rows) if i == c}
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == least
    clean = pipeline.clean_documents(spark, docs, SF)
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {30, 31}


def test_copies_of_paragraphs_go(spark):
    """Blank lines stay in a text, but a document that keeps nothing else goes."""
    a, b, c = corpus()[0][1].split("\n")
    rows = [(1, f"{a}\n\n{b}\n\n{c}"), (2, f"{a}\n\n{b}\n\n{c}"), (3, f"{a}\n\n{b}\n"), (4, f"\t{b} \r\n \t\r\n\x0b\n{c}\x0c"),
            (5, f"{a}\n\nsomething else"), (6, "\n\n"), (7, " \t\n"), (8, None), (9, "")]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["text"] for r in pipeline.distinct_lines(spark, docs, SF).collect()}
    assert got == {1: rows[0][1], 5: "\nsomething else", 6: "\n\n", 7: " \t\n", 8: None, 9: ""}
    assert {r["doc_id"] for r in pipeline.one_of_each(spark, pipeline.distinct_lines(spark, docs, SF), SF).collect()} == set(got)


def test_run_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [r["doc_id"] for r in quality.score(docs, model).collect() if r["score"] >= quality.THRESHOLD]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    lined = {i: t for i, t in plain_lines([(i, texts[i]) for i in good]) if t != ""}
    single = {i: lined[i] for i, _, c in components(list(lined.items())) if i == c}
    index = dc.Index([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    codec = bpe.codec(bpe.vocabulary_path())
    expected = {i: codec.encode(t)[0] for i, t in single.items() if not index.search(t)}
    got = {r["doc_id"]: r["token_ids"] for r in pipeline.run(spark, SF).collect()}
    # the lines' banding may miss a pair in a hundred at the bound
    assert len(set(got) ^ set(expected)) <= 0.01 * len(expected)
    assert sum(got.get(i) != ids for i, ids in expected.items()) <= 0.02 * len(expected)


def test_stages_are_the_stated_ones():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "lines", "near_copies", "benchmark", "tokens"]

"""Small tables with every awkward case, shared by the operators' tests."""

from __future__ import annotations

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
AWKWARD = [
    (1, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),     # a repeated row
    (3, None),
    (4, ""),
    (5, " \n\t \n"),
    (6, "a"),
    (7, LONG),
    (8, "Größe 日本語 \U0001f600 naïve\u0000x"),
    (9, "x" * 5000),
    (10, "line\n" * 50),
]


def documents(spark, rows=AWKWARD):
    """(doc_id, text) with further columns whose names operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    more = {c: "clash" for c in ("id", "key", "node", "n", "line", "part", "component", "shingle", "features", "place", "row", "spans", "next")}
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(v) for c, v in more.items()})


def empty(spark):
    return documents(spark).filter("doc_id < 0")

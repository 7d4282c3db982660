"""What the steps of an operator leave on disk."""

import random
import time
from pathlib import Path

from helpers import documents
from pyspark.sql import functions as F

from rollbook.llm import jaccard, lines
from rollbook.llm.common import checkpointed, let_go, written
from rollbook.llm.components import components
from rollbook.session import shared_folder


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def tables(spark):
    """Checkpoints and scratch tables."""
    shared_folder(spark)
    scratch, checkpoints = (Path(p.removeprefix("file:")) for p in (shared_folder(spark), spark.sparkContext.getCheckpointDir()))
    return {p.name for p in checkpoints.glob("rdd-*")} | {p.name for p in scratch.glob("rollbook-scratch/*")}


def near_documents():
    dice = random.Random(3)
    words = lambda n: " ".join(dice.choice(["ash", "birch", "cedar", "elm", "fir", "oak", "pine", "yew"]) for _ in range(n))
    base = [f"{words(40)}\n{words(40)}\n{words(30)}" for _ in range(6)]
    return [(i, base[i % 6].replace("cedar", "cedar larch", 1) if i % 4 == 0 else base[i % 6]) for i in range(24)]


def test_checkpoints_and_written_tables_leave_no_shuffle_files(spark):
    rows = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    before = shuffle_files(spark)
    made = [checkpointed(rows), written(rows, "test")]
    until = time.time() + 20  # executors are told, not waited for
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert [len(df.collect()) for df in made] == [7, 7]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_tables_go_when_told(spark):
    before = tables(spark)
    made = [checkpointed(spark.range(5)), written(spark.range(5), "test")]
    assert len(tables(spark) - before) == 2
    let_go(*made, spark.range(3), None)
    let_go(*made)
    assert tables(spark) == before


def test_line_dedup_leaves_only_its_result(spark):
    before = tables(spark)
    gone = lines.dropped_lines(documents(spark, near_documents()))
    assert gone.count() > 0
    assert [n.rsplit("-", 1)[0] for n in tables(spark) - before] == ["line-gone"]


def test_jaccard_join_leaves_only_its_result(spark):
    before = tables(spark)
    found = jaccard.join(documents(spark, near_documents()))
    assert found.count() == 24 and found.select("component_id").distinct().count() < 24
    assert [n.rsplit("-", 1)[0] for n in tables(spark) - before] == ["jaccard-components"]


def test_components_equal_plain_ones(spark):
    """Paths, hubs on either side, cycles, repeated and missing ends."""
    dice = random.Random(5)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(400, i) for i in range(300, 350)]
    pairs += [(500, 501), (501, 502), (502, 500), (502, 500), (600, 600), (None, 1), (700, None)]
    pairs += [(dice.randrange(1000, 1200), dice.randrange(1000, 1200)) for _ in range(120)]
    group = {x: x for p in pairs if None not in p and p[0] != p[1] for x in p}
    for _ in group:
        for x, y in pairs:
            if x in group and y in group:
                group[x] = group[y] = min(group[x], group[y])
    before = tables(spark)
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted(group.items())
    assert len(tables(spark) - before) == 1
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

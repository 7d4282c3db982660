"""Groups cut in parts give the same rows as whole ones, also against a plain Python loop."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from rollbook.operators import prefix_scan
from rollbook.operators.prefix_scan import ordered_parts
from rollbook.operators.joins import left_join_checked, lookup_reference, translate
from rollbook.operators.windows import (attach, collapse_text, fill_down_up, fill_first, fill_from_previous,
                                        keep_first, number_rows, top_rows)

ORDER = ["day", "-rank", "id"]
PARTS = 16


@pytest.fixture(scope="module")
def rows():
    """A third of all rows in one key, a third without a key, ties and gaps in the order."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        key = rng.choice(["hot", None, rng.choice("abcdefgh")])
        out.append((key, rng.choice([None, rng.randrange(30)]), rng.choice([None, "x", "y", "z"]), i,
                    rng.choice([None, None, None, float(i)]), rng.choice([None, None, f"v{i}"])))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "key string, day int, rank string, id int, a double, b string").repartition(7)


def ordered_groups(rows, by_key=True):
    def place(r):
        return (r[1] is None, r[1] or 0, r[2] is None, -ord(r[2]) if r[2] else 0, r[3])
    groups = {}
    for r in sorted(rows, key=place):
        groups.setdefault(r[0] if by_key else None, []).append(r)
    return groups


def by_id(df, *names):
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_hot_keys_are_cut_in_bounded_parts(df):
    sizes = [r["__rows"] for r in ordered_parts(df, ["key"], ORDER, PARTS).sizes().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 4 * 900 / PARTS
    assert sum(sizes) == df.filter("key = 'hot' OR key IS NULL").count()


def test_a_key_with_a_third_of_the_rows_is_spread(spark):
    many = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(500)).alias("day"))
    sizes = [(r["key"], r["__rows"]) for r in ordered_parts(many, ["key"], ["day", "id"], 50).sizes().collect()]
    assert {k for k, _ in sizes} == {-1} and len(sizes) > 10 and max(n for _, n in sizes) < 4 * 60_000 / 50
    cut = number_rows(many, ["key"], ["day", "id"], "n", 50)
    whole = number_rows(many, ["key"], ["day", "id"], "n", 1)
    assert cut.exceptAll(whole).isEmpty() and cut.count() == 60_000


def test_equal_order_values_are_cut_as_well(spark):
    same = spark.range(2000).select("id", F.lit(1).alias("key"), F.lit(5).alias("day"))
    sizes = [r["__rows"] for r in ordered_parts(same, ["key"], ["day"], 10).sizes().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 600
    assert sorted(r["n"] for r in number_rows(same, ["key"], ["day"], "n", 10).collect()) == list(range(1, 2001))
    equal = spark.range(2000).select(F.lit(1).alias("key"), F.lit(5).alias("day"))
    assert number_rows(equal, ["key"], ["day"], "n", 10).agg(F.countDistinct("n")).first()[0] == 2000


def test_parts_do_not_depend_on_partitions(spark):
    many = spark.range(5000).select("id", (F.col("id") % 2).alias("key"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("day"))
    parts = [ordered_parts(d, ["key"], ["day"], 20).df.select("id", prefix_scan.PART) for d in (many, many.repartition(13))]
    assert parts[0].exceptAll(parts[1]).isEmpty()


def test_empty_table(df):
    none = df.filter("id < 0")
    assert number_rows(none, ["key"], ORDER).count() == number_rows(none, [], ORDER).count() == 0
    assert fill_down_up(none, ["key"], ORDER, ["a"]).count() == 0


def test_map_columns_take_no_part_in_the_tie(spark):
    df = spark.range(5).select("id", F.create_map(F.lit("a"), "id").alias("m"))
    assert sorted(r["row_number"] for r in number_rows(df, [], ["id"]).collect()) == [1, 2, 3, 4, 5]


def jobs_of(spark, build):
    """How many Spark jobs run while a DataFrame is built."""
    group = f"building-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookups_and_first_values_start_no_job(spark, df):
    small = spark.createDataFrame([("hot", 1), ("a", 2)], "key string, code int")
    assert jobs_of(spark, lambda: fill_first(df, ["key"], ["day", "id"], ["a", "b"])) == 0
    assert jobs_of(spark, lambda: fill_first(df, ["key"], ORDER, ["a"])) == 0
    assert jobs_of(spark, lambda: translate(df, small, "key", "code")) == 0
    assert jobs_of(spark, lambda: left_join_checked(df, small, "key")) == 0
    assert jobs_of(spark, lambda: lookup_reference(df, small, "key", "code", "codes", "ref")) == 0
    assert jobs_of(spark, lambda: df.count()) > 0


def test_ordered_windows_start_no_job(spark, df):
    for build in (lambda: number_rows(df, ["key"], ORDER), lambda: number_rows(df, [], ORDER), lambda: fill_from_previous(df, ["key"], ORDER, ["a"]),
                  lambda: fill_down_up(df, ["key"], ORDER, ["a", "b"]), lambda: collapse_text(df, ["key"], "b", ORDER, "t")):
        assert jobs_of(spark, build) == 0


@pytest.fixture(params=[2, 32])
def sample(request, monkeypatch):
    """Few sampled rows for a part make many small and uneven parts."""
    monkeypatch.setattr(prefix_scan, "SAMPLE_PER_PART", request.param)


@pytest.mark.parametrize("parts", [PARTS, 200, 1])
def test_number_rows(df, rows, parts, sample):
    expected = {r[3]: (n,) for g in ordered_groups(rows).values() for n, r in enumerate(g, 1)}
    assert by_id(number_rows(df, ["key"], ORDER, "n", parts), "n") == expected


@pytest.mark.parametrize("parts", [PARTS, 200, 1])
def test_number_rows_of_whole_table(df, rows, parts, sample):
    expected = {r[3]: (n,) for n, r in enumerate(ordered_groups(rows, False)[None], 1)}
    assert by_id(number_rows(df, [], ORDER, "n", parts), "n") == expected


@pytest.mark.parametrize("parts", [PARTS, 200, 1])
def test_fill_from_previous(df, rows, parts, sample):
    expected = {}
    for group in ordered_groups(rows).values():
        for i, r in enumerate(group):
            before = group[i - 1] if i else (None,) * 6
            expected[r[3]] = tuple(r[c] if r[c] is not None else before[c] for c in (4, 5))
    assert by_id(fill_from_previous(df, ["key"], ORDER, ["a", "b"], parts), "a", "b") == expected


@pytest.mark.parametrize("parts", [PARTS, 200, 1])
def test_fill_down_up(df, rows, parts, sample):
    expected = {}
    for group in ordered_groups(rows).values():
        for i, r in enumerate(group):
            def fill(c):
                near = [g[c] for g in reversed(group[:i + 1]) if g[c] is not None] + [g[c] for g in group[i:] if g[c] is not None]
                return near[0] if near else None
            expected[r[3]] = (fill(4), fill(5))
    assert by_id(fill_down_up(df, ["key"], ORDER, ["a", "b"], parts), "a", "b") == expected


@pytest.mark.parametrize("order", [ORDER, ["day", "rank", "id"]])
def test_fill_first(df, rows, order):
    expected = {}
    for group in ordered_groups(rows).values():
        if order is not ORDER:
            group = sorted(group, key=lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or "", r[3]))
        first = [next((g[c] for g in group if g[c] is not None), None) for c in (4, 5)]
        for r in group:
            expected[r[3]] = tuple(r[c] if r[c] is not None else f for c, f in zip((4, 5), first))
    assert by_id(fill_first(df, ["key"], order, ["a", "b"]), "a", "b") == expected


@pytest.mark.parametrize("parts", [PARTS, 200, 1])
def test_collapse_text_in_parts_and_whole(df, rows, parts, sample):
    groups = ordered_groups(rows)
    whole = {r["key"]: r["t"] for r in collapse_text(df, ["key"], "b", ORDER, "t", "|", None, parts).collect()}
    assert whole == {k: "|".join(r[5] or "NA" for r in g) for k, g in groups.items()}
    texts_of = collapse_text(df, ["key"], "b", ORDER, "t", "|", 10, parts).collect()
    assert max(p["t"].count("|") for p in texts_of) == 9
    for key, group in groups.items():
        texts = [p["t"] for p in sorted((p for p in texts_of if p["key"] == key), key=lambda p: p["part"])]
        assert "|".join(texts) == "|".join(r[5] or "NA" for r in group)


def test_first_rows_are_pruned_before_the_shuffle(df, rows, plan_of):
    first = keep_first(df, ["key"], ORDER)
    assert {r["key"]: r["id"] for r in first.collect()} == {k: g[0][3] for k, g in ordered_groups(rows).items()}
    plan = plan_of(df.sparkSession.createDataFrame(df.collect(), df.schema).transform(lambda d: top_rows(d, ["key"], ORDER, 3)))
    assert plan.count("WindowGroupLimit") == 2


def test_attach_is_aggregated_before_the_join(df, rows, plan_of):
    totals = attach(df, ["key"], F.sum("a").alias("t"), F.count(F.lit(1)).alias("n"))
    groups = ordered_groups(rows)
    for r in totals.collect():
        assert r["n"] == len(groups[r["key"]])
    assert "Window" not in plan_of(totals) and "partial_count" in plan_of(totals)

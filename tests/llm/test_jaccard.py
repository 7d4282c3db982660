import random

import numpy as np
import pytest
from helpers import AWKWARD, documents, empty
from hypothesis import given, settings, strategies as st

from rollbook.llm import jaccard


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return sorted((i, len(sets[i]), least[i]) for i in sets)


def check(spark, rows, **more):
    got = jaccard.join(documents(spark, rows), **more).distinct().collect()
    assert sorted(map(tuple, got)) == brute_force(rows)


def variants(seed, texts, copies, edits, words=60):
    """Families of near copies whose members differ by up to `edits` words each: chains, and pairs close to the bound."""
    dice = random.Random(seed)
    rows = []
    for t in range(texts):
        base = [f"t{t}w{i}" for i in range(words)]
        for _ in range(copies):
            word = list(base)
            for _ in range(dice.randint(0, edits)):
                word[dice.randrange(len(word))] = f"x{dice.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(word)))
            if dice.random() < .3:
                base = word
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_copies_at_the_bound(spark, seed):
    check(spark, variants(seed, 6, 14, 3))


def test_regions_beyond_the_pivot_rounds(spark, monkeypatch):
    """Families with many pairs below the bound: no pivot may end the search early."""
    monkeypatch.setattr(jaccard, "PIVOT_GROWTH", 2)
    check(spark, variants(7, 2, 40, 4, 45))


def two_cells(order_of):
    """Families x, y, p, q for each order of their nodes: x and y share an article and link at the bound, p extends x and q
    extends y by what all families hold, so p-x and q-y link, and p-q, p-y and x-q do not."""
    rows, orders = [], set()
    for salt in range(2000):
        article = [f"f{salt}w{i}" for i in range(84)]
        texts = [" ".join(article + [f"{kind}{i}" for i in range(n)]) for kind, n in (("s", 10), ("t", 10), ("s", 20), ("t", 20))]
        order = order_of(texts)
        if order not in orders:
            orders.add(order)
            rows += [(len(rows) + k, t) for k, t in enumerate(texts)]
        if len(orders) == 24:
            return rows
    raise AssertionError("not all orders were met")


def test_links_between_the_cells_of_two_pivots(spark):
    """A region whose rows all stand in cells, but in two components, needs further pivots."""
    shingler = jaccard.Shingler()
    rows = two_cells(lambda texts: tuple(np.argsort([jaccard.set_key(shingler(t)) for t in texts]).tolist()))
    assert all(c == i - i % 4 for i, _, c in brute_force(rows))
    check(spark, rows)


def test_slices_of_hot_regions(spark):
    check(spark, variants(11, 3, 12, 2), slice_rows=3)


def test_sizes_and_bounds(spark):
    ten = [f"a{i}" for i in range(14)]
    rows = [(5, " ".join(ten)), (3, " ".join(ten[:-1])), (9, " ".join(ten[:-2])), (4, "A b c"), (7, "a B c"), (8, "a b"), (2, "a b c d"),
            (11, "a b c d e"), (12, "A B C D E"), (13, "\x1fa b c d e"), (14, "a b c d e")]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = jaccard.join(documents(spark)).collect()
    assert len(rows) == len(AWKWARD)
    assert sorted({tuple(r) for r in rows}) == brute_force(AWKWARD)
    assert jaccard.join(empty(spark)).count() == 0
    kept = jaccard.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted({r["doc_id"] for r in kept.collect()}) == [1, 3, 4, 5, 6, 7, 8, 9, 10]


def test_rows_of_one_id_with_other_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "c d e")]
    got = sorted({tuple(r) for r in jaccard.join(documents(spark, rows)).collect()})
    assert got == [(1, 36, 1), (2, 37, 1), (3, 37, 1), (4, 1, 4)]


def test_equals_brute_force_on_the_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(map(tuple, jaccard.join(documents).collect()))
    assert got == brute_force([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_regions_do_not_depend_on_batches(spark):
    """The stream of a task may be cut anywhere."""
    rows = [(s, n, 5, 0, 1) for s in range(40) for n in range(s % 4)] + [(100, 1, 5, 0, 2), (3, 1, 5, 0, 1)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame(sorted(rows), "shingle long, node long, n int, place int, slices int").coalesce(1)
    expected = sorted((s, n, 5, 0) for s in range(40) for n in range(s % 4) if s % 4 > 1) + [(100, 1, 5, 0)]
    try:
        for size in (1, 2, 3, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert sorted(map(tuple, jaccard.shared_regions(df).collect())) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_regions_of_the_same_nodes_are_one(spark):
    """Copies of a text share a region for every shingle of their prefixes; the first stands for all of them, and no pair is lost."""
    rows = variants(5, 3, 6, 2)
    texts = jaccard.keyed_text(documents(spark, rows))
    counts = jaccard.bucket_counts(texts)
    found = jaccard.regions(jaccard.prefixes(texts, counts), counts).cache()
    merged = jaccard.merged_regions(found).cache()

    def sets(df):
        held = {}
        for r in df.collect():
            held.setdefault(r["shingle"], {})[r["node"]] = r["place"]
        return held

    every, kept = sets(found), sets(merged)
    by_nodes = {}
    for s, places in every.items():
        by_nodes.setdefault(frozenset(places), []).append(s)
    assert len(kept) == len(by_nodes) < len(every) / 2
    assert {frozenset(p) for p in kept.values()} == set(by_nodes)
    for s, places in kept.items():
        assert all(places[n] == min(every[x][n] for x in by_nodes[frozenset(places)]) for n in places)
    copies = {(r["shingle"], r["size"], r["copies"]) for r in merged.collect()}
    assert copies == {(s, len(p), len(by_nodes[frozenset(p)])) for s, p in kept.items()}


def test_regions_of_two_that_can_not_link_go(spark):
    rows = [(1, 1, 10, 0, 2), (1, 2, 10, 0, 2), (2, 1, 10, 1, 2), (2, 3, 20, 0, 2), (3, 4, 10, 0, 2), (3, 5, 10, 2, 2), (4, 1, 10, 0, 3), (4, 6, 90, 0, 3), (4, 7, 50, 0, 3)]
    df = spark.createDataFrame(rows, "shingle long, node long, n int, place int, size long")
    assert {r["shingle"] for r in jaccard.with_partners(df).collect()} == {1, 4}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1), st.sets(st.integers(0, 40), min_size=1))
def test_linked_sets_share_a_region(a, b):
    """Triangle inequality of the outermost pivots: linked sets meet among the first shingles of each, in any order."""
    if 100 * len(a & b) >= 80 * len(a | b):
        first = [set(sorted(x)[:jaccard.prefix_size(len(x))]) for x in (a, b)]
        assert first[0] & first[1]


def test_shingler_is_exact():
    shingler = jaccard.Shingler()
    texts = ["a b c d e f", "a b c d e", "a b c d", "a b c", "", "a b c d e a b c d e", "b a c d e"]
    for x in texts:
        for y in texts:
            shared = len(np.intersect1d(shingler(x), shingler(y)))
            assert shared == len(shingles(x) & shingles(y))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1))
def test_linked_sets_pass_where_they_first_meet(a, b):
    if 100 * len(a & b) >= 80 * len(a | b):
        first = min(a & b)
        i, j = sorted(a).index(first), sorted(b).index(first)
        shared = -(-(len(a) + len(b)) * 80 // 180)
        assert i < jaccard.prefix_size(len(a)) and j < jaccard.prefix_size(len(b))
        assert len(a) - i >= shared and len(b) - j >= shared

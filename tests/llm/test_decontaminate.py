import random

from helpers import AWKWARD, documents, empty

from rollbook.llm import decontaminate as dc, queries

SF = "/root/testdata/sf0.001"


def edited(words, edits, dice, other):
    words = list(words)
    for _ in range(edits):
        kind, at = dice.choice("sid"), dice.randrange(len(words))
        if kind == "s":
            words[at] = dice.choice(other)
        elif kind == "d" and len(words) > 1:
            del words[at]
        else:
            words.insert(at, dice.choice(other))
    return words


def test_recall_at_the_bound_and_exact_distances():
    dice = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(dice.choice(vocabulary) for _ in range(dice.randint(8, 60)))) for i in range(60)]
    index = dc.Index(items)
    found = 0
    for i, text in items:
        words = text.split()
        inside = edited(words, dc.allowed_edits(len(words)), dice, vocabulary)
        places = index.search(" ".join(["left"] * 20 + inside + ["right"] * 20))
        found += any(p[0] == i for p in places)
        for item, first, last, distance in places:
            target = dict(items)[item].split()
            got = (["left"] * 20 + inside + ["right"] * 20)[first:last + 1]
            assert levenshtein(target, got) == distance <= dc.allowed_edits(len(target))
    assert found >= dc.RECALL * len(items)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_bounds_that_leave_no_match_out():
    """Any way to place the edits leaves a run of the stated length whole."""
    for n in range(1, 80):
        k = dc.allowed_edits(n)
        assert k * 5 <= n
        pieces, rest = k + 1, n - k
        assert -(-rest // pieces) == dc.whole_run(n, k) >= 1


def test_ends_short_items_and_repeats():
    index = dc.Index([(1, "Alpha beta"), (2, "alpha beta gamma delta epsilon zeta"), (2, "one two three four five"), (3, None or ""), (4, "solo")])
    assert index.search("alpha beta") == [(1, 0, 1, 0)]
    assert sorted(index.search("ALPHA\tbeta x alpha  beta")) == [(1, 0, 1, 0), (1, 3, 4, 0)]
    assert (2, 0, 5, 0) in index.search("alpha beta gamma delta epsilon zeta")
    assert (2, 0, 4, 1) in index.search("alpha beta gamma delta zeta")
    assert index.search("one two three four five solo") == [(2, 0, 4, 0), (4, 5, 5, 0)]
    assert index.search("") == []


def test_equals_brute_force_on_the_table(spark):
    docs = {r["doc_id"]: dc.words_of(r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: dc.words_of(r["text"] or "") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op1_decontamination"](spark, SF).collect()}
    expected = set()
    for i, item in items.items():
        known = {w: n for n, w in enumerate(set(item), 1)}
        ids = [known[w] for w in item]
        for d, words in docs.items():
            text = [known.get(w, 0) for w in words]
            if len(set(item) & set(words)) * 2 >= len(set(item)) and dc.align(ids, text, dc.allowed_edits(len(item))):
                expected.add((d, i))
    assert got == expected and expected


def test_awkward_rows_and_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(1, "two three four five six"), (2, None), (3, ""), (None, "seven eight nine ten"), (4, "w5 w6 w7 w8 w9")],
                                  "item_id long, text string")
    expected = {(1, 1), (2, 1), (7, 4)}
    got = dc.find(documents(spark), items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected
    assert got.filter("doc_id = 2").count() == 2
    clean = dc.keep_clean(documents(spark), items)
    assert clean.columns == documents(spark).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in AWKWARD if i not in (1, 2, 7))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 60)
    assert {(r["doc_id"], r["item_id"]) for r in dc.find(documents(spark), items).collect()} == expected
    assert dc.find(empty(spark), items).count() == 0
    assert dc.find(documents(spark), items.filter("item_id < 0")).count() == 0

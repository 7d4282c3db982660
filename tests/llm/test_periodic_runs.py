import random
import re
import time

import numpy as np
from helpers import AWKWARD, documents, empty

from rollbook.llm import periodic_runs

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(words):
    """All maximal stretches of every lag, the shortest lag of equal ones."""
    found = {}
    codes = {w: i for i, w in enumerate(words)}
    x = np.array([codes[w] for w in words], dtype=np.int64)
    for q in range(1, len(words) // 4 + 1):
        differ = np.concatenate(([-1], np.flatnonzero(x[:-q] != x[q:]), [len(words) - q]))
        for k in np.flatnonzero(np.diff(differ) - 1 + q >= max(6, 4 * q)):
            found.setdefault((int(differ[k]) + 1, int(differ[k + 1] - differ[k]) - 1 + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def whole(text, plant=None):
    words = WORDS.findall(text or "")
    if plant:
        a, p = plant
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def found(codes):
    codes = np.array(codes, dtype=np.int64)
    return [(start + s, n, q) for start, end in periodic_runs.split_by_frequency(codes, np.array([0, len(codes)]))
            for s, n, q in periodic_runs.lag_scan(codes[start:end])]


def test_random_words_equal_brute_force():
    dice = random.Random(2)
    n_runs = 0
    for _ in range(2500):
        words = []
        letters = dice.randint(1, 6)
        for _ in range(dice.randint(1, 8)):
            period = [dice.randrange(letters) for _ in range(dice.randint(1, 9))]
            words += (period * dice.randint(1, 8))[:dice.randint(1, 70)]
        runs = brute(words)
        n_runs += len(runs)
        assert sorted(found(words), key=lambda r: (r[0], r[2])) == runs, words
    assert n_runs > 2000


def test_nested_and_touching_runs():
    assert found([0] * 6) == [(0, 6, 1)]
    assert found([0] * 5) == []
    assert found([0, 1] * 4) == [(0, 8, 2)] and found([0, 1] * 3 + [0]) == []
    inner = ([0] * 6 + [1]) * 4
    assert sorted(found(inner)) == sorted(brute(inner)) and (0, 28, 7) in found(inner)


def test_long_segments_take_no_quadratic_time():
    start = time.perf_counter()
    assert found(np.zeros(200_000)) == [(0, 200_000, 1)]
    assert found(np.arange(200_000) % 30_000) == [(0, 200_000, 30_000)]
    assert len(found(np.arange(200_000) // 10 % 50)) == 20_001
    assert time.perf_counter() - start < 60


def test_rows(spark):
    rows = AWKWARD + [(None, "a a a a a a a"), (12, "x y " * 9 + "z z" + " \x0b\x0c\r\n" + "é " * 7), (13, "A a " * 3)]
    got = periodic_runs.find_runs(documents(spark, rows)).collect()
    wanted = [(i, *whole(t)) for i, t in rows]
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=repr) == sorted(wanted, key=repr)
    for r in got:
        best = max(r["runs"], key=lambda x: (x["length"] / x["period"], -x["start"], -x["period"]), default=None)
        assert (r["runs"][r["best"]] if r["best"] is not None else None) == best


def test_planted_rows(spark):
    """Ids over a range, so that some texts repeat themselves; the rest stays as it is."""
    dice = random.Random(3)
    rows = [(i, " ".join(dice.choice("abcdefgh") + str(dice.randrange(9)) for _ in range(dice.randrange(90)))) for i in range(300)]
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(documents(spark, rows), plant=periodic_runs.looped).collect()}
    n = 0
    for i, text in rows:
        plant = periodic_runs.looped(i, len(WORDS.findall(text)))
        n += plant is not None
        runs, collapsed = whole(text, plant)
        assert ([tuple(x) for x in got[i]["runs"]], got[i]["collapsed"]) == (runs, collapsed)
    assert n > 15
    assert periodic_runs.looped(None, 5) is None


def test_empty_table(spark):
    assert periodic_runs.find_runs(empty(spark)).count() == 0

"""Benchmark decontamination: finds places in documents that are within a bound of edits of a benchmark item.

Edits are counted in words (runs without ASCII white space, A-Z lower-cased). An item of n words matches a place at an
edit distance of at most `floor((1 - SIMILARITY) * n)`.

The CGK embedding turns edit distance into Hamming distance: a walk of 3 n steps copies the current word and moves on to the
next with a random bit of (step, word), so equal sequences give equal copies, and after an edit the two walks meet again. Items and
item-sized windows of documents are embedded by `WALKS` walks; each is sampled `SAMPLES` times at `PLACES` steps, and a
window that agrees with an item on all places of a sample is a candidate. The repetitions give the target recall
`RECALL`, which the tests measure at the bound. Candidates are verified by exact alignment around the window.

k edits leave one of the k + 1 pieces between them whole, so every match shares a run of ceil((n - k) / (k + 1)) words with
the item. Only windows aligned to such a run are embedded; this leaves out no match.

Items come in blocks of at most `BLOCK_BYTES`, each sent to the tasks; documents are read once for each block and not
shuffled. Missing and empty items match nothing, missing and empty documents have no places; repeated rows of either
side each have their results; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import keyed_text, per_text

SIMILARITY = 0.8
RECALL = 0.95
WALKS = 8
SAMPLES = 16
PLACES = 2
STRETCH = 3
BLOCK_BYTES = 8 << 20
SEED = 20_240_601


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def allowed_edits(n: int, similarity: float = SIMILARITY) -> int:
    return int(round((1 - similarity) * 1000)) * n // 1000


def whole_run(n: int, edits: int) -> int:
    """The length of a run of words that any `edits` edits leave whole."""
    return -(-(n - edits) // (edits + 1))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix, so that bits of neighbouring numbers are independent."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def embed(rows: np.ndarray) -> np.ndarray:
    """CGK embeddings of the rows, all of one length, by all walks: (walk, row, step); -1 after the end."""
    count, n = rows.shape
    padded = np.concatenate([rows, np.full((count, 1), -1, dtype=np.int64)], axis=1)
    at = np.zeros((WALKS, count), dtype=np.int64)
    every = np.arange(count)[None, :]
    walks = np.uint64(SEED) + np.uint64(7919) * np.arange(WALKS, dtype=np.uint64)[:, None]
    out = np.empty((WALKS, count, STRETCH * n), dtype=np.int64)
    for step in range(STRETCH * n):
        out[:, :, step] = symbol = padded[every, at]
        bits = mixed(symbol.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + walks + np.uint64(104_729 * step))
        at = np.minimum(at + (bits & np.uint64(1)).view(np.int64), n)
    return out


def samples(n: int) -> np.ndarray:
    """For every walk and sample the sampled steps, the same for all sequences of n words. They lie in the first two
    thirds, where a walk has seldom reached the end."""
    dice = np.random.default_rng(SEED + n)
    return dice.integers(0, max(1, 2 * n), size=(WALKS, SAMPLES, PLACES))


def keys(rows: np.ndarray) -> np.ndarray:
    """A row of `WALKS` x `SAMPLES` hash keys for each sequence; all have one length."""
    steps = samples(rows.shape[1])
    copies = embed(rows)
    key = np.zeros((WALKS, SAMPLES, len(rows)), dtype=np.uint64)
    for place in range(PLACES):
        taken = np.take_along_axis(copies, steps[:, None, :, place], axis=2)  # (walk, row, sample)
        key = mixed(key * np.uint64(31) + taken.transpose(0, 2, 1).astype(np.uint64) + np.uint64(1))
    return key.reshape(WALKS * SAMPLES, len(rows)).T


def align(item: Sequence[int], text: Sequence[int], edits: int) -> tuple[int, int, int] | None:
    """The place in the text nearest to the item, as (distance, start, end), if within the bound; of equal distances the first."""
    n = len(item)
    if list(text[edits:edits + n]) == list(item):
        return 0, edits, edits + n
    # one row for each prefix of the item: (distance, start) of the best alignment that ends at each place
    last = [(0, j) for j in range(len(text) + 1)]
    for i, word in enumerate(item, 1):
        row = [(i, 0)]
        for j, other in enumerate(text, 1):
            d, start = last[j - 1]
            best = (d + (word != other), start)
            d, start = last[j]
            if d + 1 < best[0]:
                best = (d + 1, start)
            d, start = row[j - 1]
            if d + 1 < best[0]:
                best = (d + 1, start)
            row.append(best)
        last = row
        if min(last)[0] > edits:
            return None
    (distance, start), end = min((cell, j) for j, cell in enumerate(last))
    return (distance, start, end) if distance <= edits else None


class Index:
    """The items of a block, ready to be looked for in texts."""

    def __init__(self, items: Sequence[tuple[int, str]], similarity: float = SIMILARITY):
        self.known: dict[bytes, int] = {}
        self.items: list[tuple[int, list[int], int]] = []   # id, words, allowed edits
        self.runs: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))  # length: run: (item, place)
        by_size: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            words = [self.known.setdefault(w, len(self.known) + 1) for w in words_of(text)]
            if not words:
                continue
            edits = allowed_edits(len(words), similarity)
            number = len(self.items)
            self.items.append((item_id, words, edits))
            by_size[len(words)].append(number)
            length = whole_run(len(words), edits)
            for place in range(len(words) - length + 1):
                self.runs[length][tuple(words[place:place + length])].append((number, place))
        self.runs = {length: dict(runs) for length, runs in self.runs.items()}
        self.sizes = {n: len(numbers) for n, numbers in by_size.items()}
        self.buckets: dict[int, list[dict[int, list[int]]]] = {}
        for n, numbers in by_size.items():
            found = keys(np.array([self.items[i][1] for i in numbers], dtype=np.int64))
            tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(found.shape[1])]
            for number, row in zip(numbers, found.tolist()):
                for column, key in enumerate(row):
                    tables[column][key].append(number)
            self.buckets[n] = [dict(t) for t in tables]
        self.sorted_runs = {length: np.unique(self._codes(np.array([list(r) for r in runs], dtype=np.int64), length)[:, 0])
                            for length, runs in self.runs.items()}

    @staticmethod
    def _codes(rows: np.ndarray, length: int) -> np.ndarray:
        """Hash codes of the runs of `length` that start at each place of the rows."""
        places = rows.shape[1] - length + 1
        code = np.zeros((rows.shape[0], places), dtype=np.uint64)
        for i in range(length):
            code = code * np.uint64(0x9E3779B97F4A7C15) + rows[:, i:i + places].astype(np.uint64)
        return code

    def windows(self, ids: np.ndarray) -> dict[int, set[int]]:
        """Item size: starts of the windows that share a whole run with an item of that size, aligned to it."""
        starts: dict[int, set[int]] = defaultdict(set)
        for length, codes in self.sorted_runs.items():
            if len(ids) < length:
                continue
            here = self._codes(ids[None, :], length)[0]
            at = np.minimum(np.searchsorted(codes, here), len(codes) - 1)
            for place in np.flatnonzero(codes[at] == here).tolist():
                for number, offset in self.runs[length].get(tuple(ids[place:place + length].tolist()), ()):
                    starts[len(self.items[number][1])].add(place - offset)
        return starts

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, first word, last word, distance) of all places; of overlapping ones of an item the nearest."""
        words = words_of(text)
        ids = np.fromiter(map(self.known.get, words, [0] * len(words)), dtype=np.int64, count=len(words))
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for n, starts in self.windows(ids).items():
            ordered = sorted(starts)
            wide = np.concatenate([np.zeros(n, dtype=np.int64), ids, np.zeros(n, dtype=np.int64)])
            rows = wide[np.add.outer(np.array(ordered) + n, np.arange(n))]
            for start, row in zip(ordered, keys(rows).tolist()):
                near = {number for table, key in zip(self.buckets[n], row) for number in table.get(key, ())}
                for number in near:
                    item_id, item, edits = self.items[number]
                    base = start - edits
                    place = align(item, wide[max(0, n + base):n + start + n + edits].tolist(), edits)
                    if place:
                        base = max(base, -n)
                        found[item_id].append((place[0], max(0, base + place[1]), min(len(ids), base + place[2]) - 1))
        return [(item_id, first, last, distance) for item_id, places in found.items() for distance, first, last in apart(places)]


def apart(places: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Places (distance, first, last) without those that overlap a nearer one."""
    kept: list[tuple[int, int]] = []
    for distance, first, last in sorted(set(places)):
        if all(last < a or b < first for a, b in kept):
            kept.append((first, last))
            yield distance, first, last


def indexes(items: DataFrame, similarity: float = SIMILARITY, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The items as indexes of bounded blocks; only one block is in the driver at a time."""
    keyed = keyed_text(items, id_col, text_col).filter(F.col("id").isNotNull())
    size = keyed.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK_BYTES)) if size > BLOCK_BYTES else 1
    for block in range(blocks):
        rows = keyed.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block) if blocks > 1 else keyed
        yield Index([(r["id"], r["text"]) for r in rows.collect()], similarity)


PLACES_FIELDS = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("distance", pa.int32())])


def find(df: DataFrame, items: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each place of an item in a document: document id, item_id, first and last word (from 0), distance."""
    keyed = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))

    def with_index(index: Index) -> DataFrame:
        def make():
            def work(ids, texts):
                rows = [(i, *place) for i, t in zip(ids, texts) for place in index.search(t)]
                return [list(c) for c in zip(*rows)] or [[]] * 5
            return work
        return per_text(keyed, make, PLACES_FIELDS, "id long, item_id long, first_word long, last_word long, distance int")

    blocks = [with_index(i) for i in indexes(items, similarity, item_id_col, item_text_col)]
    return reduce(DataFrame.unionByName, blocks).withColumnRenamed("id", id_col)


def keep_clean(df: DataFrame, items: DataFrame, similarity: float = SIMILARITY, text_col: str = "text") -> DataFrame:
    """The documents without any place of an item, with all their columns. Nothing is joined: each row is tested where it is."""
    for index in indexes(items, similarity):
        clean = F.pandas_udf(_alone(index), "boolean")
        df = df.filter(clean(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return df


def _alone(index: Index):
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: not index.search(t)).astype(bool)
    return clean

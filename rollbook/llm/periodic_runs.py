"""Periodic runs of words: stretches that repeat a period of q words, of at least max(6, 4 q) words.

Every word of such a run occurs at least four times in it. So a word that occurs less often within its segment (at first
the whole text) belongs to no run and splits the segment; the parts are counted anew until nothing changes. Segments that
survive are scanned by lag: for every q the segment is cut into blocks of q words, and a run shows as two neighbouring
pairs of equal blocks (compared by hashes that equal blocks share, m / q of them for m words). Only lags that show one
outside the runs known already are compared word by word, so a segment costs about m log m steps, however it repeats.

A stretch whose smallest period is shorter was found at that lag before, and it is the same stretch: a run is kept once.

Words are stretches without space, tab, line break, vertical tab, form feed and carriage return. Missing and empty texts
have no words and no runs. Repeated rows and ids give a row each; other columns are not read. A text is held whole in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import keyed_text, small_batches

LEAST_WORDS = 6
LEAST_PERIODS = 4
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BASE = np.uint64(0x9E3779B97F4A7C15)  # of the block hashes; odd, so that its powers never vanish


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All words as numbers, where each text's words start and end, and the distinct words. White space is ASCII, so bytes do."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0]:ends[-1]] if held is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    black = np.zeros(len(data) + 2, bool)
    black[1:-1] = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's words do not go on in the next text
    edge[ends] = True
    starts = np.flatnonzero(black[1:] & (~black[:-1] | edge))
    stops = np.flatnonzero(black[:-1] & (~black[1:] | edge))
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=offsets[1:])
    held = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[black[1:-1]])])
    coded = held.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), np.searchsorted(starts, ends), coded.dictionary


def split_by_frequency(codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the segments in which every word occurs often enough, of many texts at once."""
    place = np.arange(len(codes))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    settled: list[tuple[int, int]] = []
    while len(place):
        _, same, times = np.unique(segment * (len(codes) + 1) + codes[place], return_inverse=True, return_counts=True)
        often = times[same] >= LEAST_PERIODS
        changed = np.zeros(segment[-1] + 1, bool)
        changed[segment[~often]] = True
        whole = ~changed[segment]          # nothing left to split: these segments survive as they are
        first = np.flatnonzero(whole & np.append(True, np.diff(segment) != 0))
        last = np.flatnonzero(whole & np.append(np.diff(segment) != 0, True))
        settled += [(s, e + 1) for s, e in zip(place[first].tolist(), place[last].tolist()) if e + 1 - s >= LEAST_WORDS]
        kept = often & ~whole
        place, segment = place[kept], segment[kept]
        if not len(place):
            break
        segment = np.append(0, np.cumsum((np.diff(place) != 1) | (np.diff(segment) != 0)))
        long = np.bincount(segment)[segment] >= LEAST_WORDS
        place, segment = place[long], segment[long]
    return sorted(settled)


class Known:
    """Runs found at shorter lags. Runs whose periods have the same number of bits do not lie within each other,
    so of each such class only the last one that starts at or before a place can hold a stretch of three periods there."""

    def __init__(self) -> None:
        self.classes: dict[int, tuple[list[int], list[int]]] = {}

    def add(self, runs: list[tuple[int, int, int]]) -> None:
        for start, length, period in runs:
            starts, ends = self.classes.setdefault(period.bit_length(), ([], []))
            at = bisect_right(starts, start)
            starts.insert(at, start)
            ends.insert(at, start + length)

    def holds(self, start: int, end: int) -> bool:
        for starts, ends in self.classes.values():
            at = bisect_right(starts, start) - 1
            if at >= 0 and ends[at] >= end:
                return True
        return False


def _stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.diff(np.concatenate(([0], true.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a segment."""
    m = len(words)
    power = np.full(m + 1, BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    hashes = np.zeros(m + 1, np.uint64)
    np.cumsum((words.astype(np.uint64) + np.uint64(1)) * BASE * power[:-1], out=hashes[1:])
    known, found, seen = Known(), [], set()
    for q in range(1, m // LEAST_PERIODS + 1):
        blocks = np.diff(hashes[::q])
        equal = blocks[:-1] * power[q] == blocks[1:]
        if not (equal[:-1] & equal[1:]).any():
            continue
        starts, ends = _stretches(equal)
        shown = ends - starts >= 2
        if all(known.holds(s * q, (e + 1) * q) for s, e in zip(starts[shown].tolist(), ends[shown].tolist())):
            continue
        starts, ends = _stretches(words[:-q] == words[q:])
        long = ends - starts >= max(LEAST_WORDS, LEAST_PERIODS * q) - q
        runs = [(s, e - s + q, q) for s, e in zip(starts[long].tolist(), ends[long].tolist()) if (s, e + q) not in seen]
        seen.update((s, s + length) for s, length, _ in runs)
        known.add(runs)
        found += runs
    return sorted(found, key=lambda run: (run[0], run[2]))


def looped(key: int | None, n: int) -> tuple[int, int] | None:
    """For one id in ten: the word a from which a text repeats itself, and the period p. A row without an id stays as it is."""
    h = crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
FIELDS = pa.schema([("id", pa.int64()), ("runs", RUNS), ("best", pa.int32()), ("collapsed", pa.string())])
RUNS_DDL = "array<struct<start: long, length: long, period: long>>"


def _best(runs: list[tuple[int, int, int]]) -> int | None:
    """Place of the run with the most periods; of equal ones the first, and of those the one with the shortest period."""
    best = None
    for i, (_, length, period) in enumerate(runs):  # by start, then period
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              plant: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """A row for each text: its id, `runs` by start and period, `best`, the place in them (from 0) of the run with the most
    periods, and `collapsed`, the words left when of every run only the first period stays, joined by a space.

    `plant` may change texts first: from an id and the number of words to (a, p), so that from word a on the
    text repeats its p words from there, or None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            codes, bounds, distinct = words_of(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, key in enumerate(ids if plant else []):
                start, n = bounds[i], bounds[i + 1] - bounds[i]
                change = plant(key, int(n))
                if change:
                    a, p = change
                    codes[start + a:start + n] = codes[start + a + np.arange(n - a) % p]
            runs: list[list] = [[] for _ in ids]
            dropped = np.zeros(len(codes) + 1, np.int64)
            for start, end in split_by_frequency(codes, bounds):
                text = int(np.searchsorted(bounds, start, side="right")) - 1
                for s, length, q in lag_scan(codes[start:end]):
                    runs[text].append((start + s - int(bounds[text]), length, q))
                    dropped[start + s + q] += 1
                    dropped[start + s + length] -= 1
            kept = np.cumsum(dropped[:-1]) == 0
            offsets = np.append(0, np.cumsum(kept))[bounds]
            words = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), distinct.take(pa.array(codes[kept])))
            yield pa.record_batch([batch.column(0), pa.array([[dict(zip(("start", "length", "period"), r)) for r in of] for of in runs], type=RUNS),
                                   pa.array([_best(of) for of in runs], type=pa.int32()),
                                   pc.binary_join(words, pa.scalar(b" ", pa.large_binary())).cast(pa.string())], schema=FIELDS)

    texts = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return texts.mapInArrow(run, f"id long, runs {RUNS_DDL}, best int, collapsed string").withColumnRenamed("id", id_col)

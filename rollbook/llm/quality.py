"""Quality scores learned from preferences (Bradley-Terry).

A document's strength is a linear function of its features, and a document labelled 1 is preferred to one labelled 0
with the logistic probability of their difference. Weights minimise that loss over all pairs of a labelled row of either
kind; only differences enter, so the scale is set afterwards: the threshold is the quantile of the training scores at the
share of label 0, and it is put at `THRESHOLD` of a score between 0 and 1.

The fit uses every labelled row that is not held out. A pair's loss depends on two strengths, so rows need not meet: each
is spread over the `STEPS` nodes a unit of strength that lie next to its own, with the weights of cubic interpolation, and the
pairs of nodes stand for all pairs of rows (to about 1e-6 of a pair's slope). Each Newton step is one pass in tasks, which brings the sums of
products at each node to the driver: strengths are bounded by the penalty, so this is too, however many rows there are.
Features are computed in tasks, over whole texts. Missing texts are empty and have
features 0. Labels that are missing or belong to no document are left out; of repeated labels each counts. Without both labels there is no
preference: all scores are 0.5. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import keyed_text, only_maybe, per_text, written

STEPS = 8
NODES_AT_ONCE = 1024
BINS = 4096
FEW = 8192
THRESHOLD = 0.3
PENALTY = 1e-3

NAMES = ("words", "word_length", "distinct", "commonest", "repeated_next", "upper", "symbols", "bars", "digits", "lines", "line_length",
         "repeated_lines", "all_upper", "symbol_ends", "capitals", "stops", "letters")
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[[ord(c) for c in ".,;:'-\"()?!"]] = True
_SYMBOL_BYTES = frozenset(np.flatnonzero(_SYMBOLS & ~_PLAIN).tolist()) | {ord("!")}


def features(text: str) -> list[float]:
    """Shares and logarithms of counts that describe a text's form, none of them a word of its own."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(NAMES)
    n = len(words)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    total = len(data)
    letters = int(counts[0x41:0x5B].sum() + counts[0x61:0x7B].sum() + counts[0x80:].sum())
    odd = int(counts[_SYMBOLS & ~_PLAIN].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen = Counter(words)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    last = [w[-1] for w in words]
    share = lambda x, of=total: math.log1p(100 * x / of)
    return [math.log(n), math.log(total / n), len(seen) / n, share(max(seen.values()), n), share(repeated, n),
            share(int(counts[0x41:0x5B].sum())), share(odd), share(int(counts[0x7C])), share(int(counts[0x30:0x3A].sum())),
            math.log(len(lines)), math.log(total / len(lines)), share(len(lines) - len(set(lines)), len(lines)),
            share(sum(map(bytes.isupper, words)), n), share(sum(c in _SYMBOL_BYTES for c in last), n),
            share(sum(1 for w in words if 0x41 <= w[0] <= 0x5A), n), share(int(counts[0x2E])), letters / total]


FIELDS = pa.schema([("id", pa.int64()), ("features", pa.list_(pa.float64()))])


def with_features(keyed: DataFrame) -> DataFrame:
    return per_text(keyed, lambda: lambda ids, texts: (ids, [features(t) for t in texts]), FIELDS, "id long, features array<double>")


def standard(matrix: np.ndarray, mean: list[float], scale: list[float]) -> np.ndarray:
    return np.clip((matrix - mean) / scale, -4, 4)


@dataclass
class Model:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    cut: float

    def strength(self, matrix: np.ndarray) -> np.ndarray:
        return standard(matrix, self.mean, self.scale) @ np.array(self.weights)

    def score(self, matrix: np.ndarray) -> np.ndarray:
        if not any(self.weights):
            return np.full(len(matrix), 0.5)
        shift = math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(self.strength(matrix) - self.cut + shift, -30, 30)))


Nodes = dict[tuple[int, int], np.ndarray]  # by label and node: sums of products of (1, features) with themselves


def spread(found: Nodes, scaled: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Nodes:
    """Adds the rows to the four nodes around their strength."""
    place = scaled @ weights * STEPS
    base = np.floor(place).astype(np.int64)
    t = place - base
    parts = np.array([-t * (t - 1) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, -(t + 1) * t * (t - 2) / 2, (t + 1) * t * (t - 1) / 6])
    rows = np.column_stack([np.ones(len(scaled)), scaled])
    order = np.lexsort((base, labels))
    changes = np.flatnonzero(np.diff(labels[order]) | np.diff(base[order])) + 1
    for some in np.split(order, changes) if len(order) else []:
        for j, part in enumerate(parts):
            at = int(labels[some[0]]), int(base[some[0]]) + j - 1
            products = (rows[some] * part[some, None]).T @ rows[some]
            found[at] = found[at] + products if at in found else products
    return found


def slope_and_bend(found: Nodes, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the mean loss over all pairs."""
    (at_good, good), (at_bad, bad) = ((np.array([n for k, n in found if k == label]) / STEPS, np.array([m for (k, _), m in found.items() if k == label]))
                                      for label in (1, 0))
    size = len(weights)
    slope, bend = np.zeros(size), np.zeros((size, size))
    for i in range(0, len(good), NODES_AT_ONCE):
        some = good[i:i + NODES_AT_ONCE]
        wrong = 1 / (1 + np.exp(np.clip(at_good[i:i + NODES_AT_ONCE, None] - at_bad, -500, 500)))
        curve = wrong * (1 - wrong)
        slope -= (wrong @ bad[:, 0, 0]) @ some[:, 0, 1:] - (some[:, 0, 0] @ wrong) @ bad[:, 0, 1:]
        both = some[:, 0, 1:].T @ curve @ bad[:, 0, 1:]
        bend += np.tensordot(curve @ bad[:, 0, 0], some[:, 1:, 1:], 1) + np.tensordot(some[:, 0, 0] @ curve, bad[:, 1:, 1:], 1) - both - both.T
    pairs = good[:, 0, 0].sum() * bad[:, 0, 0].sum()
    return slope / pairs + PENALTY * weights, bend / pairs + PENALTY * np.eye(size)


def newton(spread_by: Callable[[np.ndarray], Nodes]) -> np.ndarray:
    """Newton steps on the mean logistic loss of all pairs, with a small penalty on the weights."""
    weights = np.zeros(len(NAMES))
    for _ in range(25):
        slope, bend = slope_and_bend(spread_by(weights), weights)
        step = np.linalg.solve(bend, slope)
        weights = weights - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit(matrix: np.ndarray, labels: np.ndarray) -> Model:
    """The model of rows at hand."""
    mean = matrix.mean(axis=0) if len(matrix) else np.zeros(len(NAMES))
    scale = matrix.std(axis=0) + 1e-9 if len(matrix) else np.ones(len(NAMES))
    bad = (labels == 0).sum()
    if bad in (0, len(labels)):
        return Model(mean.tolist(), scale.tolist(), [0.0] * len(NAMES), 0.0)
    scaled = standard(matrix, mean, scale)
    weights = newton(lambda w: spread({}, scaled, labels.astype(np.int64), w))
    return Model(mean.tolist(), scale.tolist(), weights.tolist(), float(np.quantile(scaled @ weights, bad / len(labels))))


NODES = pa.schema([("label", pa.int32()), ("node", pa.int64()), ("products", pa.list_(pa.float64()))])
NODES_DDL = "label int, node long, products array<double>"


def _matrix(batch: pa.RecordBatch | pa.Table, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _spread(mean: list[float], scale: list[float], weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Nodes = {}
        for batch in batches:
            scaled = standard(_matrix(batch, "features", len(NAMES)), mean, scale)
            spread(found, scaled, batch.column("label").to_numpy().astype(np.int64), weights)
        yield pa.record_batch([pa.array([k for k, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int64()),
                               pa.array([m.ravel() for m in found.values()], NODES.field(2).type)], schema=NODES)

    return run


def _summed(rows: pa.Table) -> pa.Table:
    products = _matrix(rows.combine_chunks().to_batches()[0], "products", (len(NAMES) + 1) ** 2).sum(axis=0)
    return pa.table([rows.column("label").slice(0, 1), rows.column("node").slice(0, 1), pa.array([products], NODES.field(2).type)], schema=NODES)


def spread_rows(rows: DataFrame, mean: list[float], scale: list[float], weights: np.ndarray) -> Nodes:
    nodes = rows.mapInArrow(_spread(mean, scale, weights), NODES_DDL).groupBy("label", "node").applyInArrow(_summed, NODES_DDL)
    size = len(NAMES) + 1
    return {(r["label"], r["node"]): np.array(r["products"]).reshape(size, size) for r in nodes.orderBy("label", "node").collect()}


def value_at(df: DataFrame, column: str, place: int) -> float:
    """The value at this place (from 0) of the ascending order: counts in ever narrower ranges lead to it."""
    value = F.col(column)
    while True:
        low, high, n = df.agg(F.min(value), F.max(value), F.count(value)).first()
        if low == high:
            return low
        if n <= FEW:
            return sorted(r[0] for r in df.select(value).collect())[place]
        bin_of = F.least(F.floor((value - low) / (high - low) * BINS), F.lit(BINS - 1))
        for chosen, count in df.groupBy(bin_of.alias("bin")).count().orderBy("bin").collect():
            if place < count:
                break
            place -= count
        df = df.filter(bin_of == chosen)


def quantile(df: DataFrame, column: str, share: float) -> float:
    """Exact, between two values in proportion."""
    place = (df.count() - 1) * share
    low, high = (value_at(df, column, int(p)) for p in (math.floor(place), math.ceil(place)))
    return low + (high - low) * (place - math.floor(place))


def held_out(doc_id: Column) -> Column:
    """One document in five is kept from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fits on all labelled documents that are not held out. Texts are read once more, but only their features are shuffled."""
    usable = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("label"))
    usable = usable.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    keyed = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    found = with_features(only_maybe(keyed.filter(~held_out(F.col("id"))), "id", usable, "id"))
    rows = written(found.join(usable, "id").select("label", "features"), "quality-features")

    each = [F.col("features")[i] for i in range(len(NAMES))]
    n, bad, *sums = rows.agg(F.count(F.lit(1)), F.count_if(F.col("label") == 0), *map(F.avg, each), *map(F.stddev_pop, each)).first()
    mean = [float(x or 0) for x in sums[:len(NAMES)]]
    scale = [float(x) + 1e-9 for x in sums[len(NAMES):]] if n else [1.0] * len(NAMES)
    if bad in (0, n):
        return Model(mean, scale, [0.0] * len(NAMES), 0.0)
    weights = newton(lambda w: spread_rows(rows, mean, scale, w))

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(standard(_matrix(batch, "features", len(NAMES)), mean, scale) @ weights)], ["strength"])

    cut = quantile(written(rows.mapInArrow(strengths, "strength double"), "quality-strengths"), "strength", bad / n)
    return Model(mean, scale, weights.tolist(), cut)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id and `score` between 0 and 1."""
    fields = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def make():
        return lambda ids, texts: (ids, pa.array(model.score(np.array([features(t) for t in texts]))))

    keyed = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return per_text(keyed, make, fields, "id long, score double").withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns. The score is computed beside the row, as
    a column, so that nothing is joined."""
    model = learn(df, labels, id_col, text_col)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in texts]).reshape(len(texts), len(NAMES))))

    return df.filter(scored(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) >= THRESHOLD)

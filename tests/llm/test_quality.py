import zlib

import numpy as np
from helpers import AWKWARD, documents, empty

from rollbook.llm import quality, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES["op7_quality_ranking"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    good = [r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 1]
    bad = [r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.95 and np.mean([b < 0.3 for b in bad]) > 0.9


def test_fit_recovers_a_ranking():
    dice = np.random.default_rng(1)
    matrix = dice.normal(size=(600, len(quality.NAMES)))
    truth = np.linspace(-1, 1, len(quality.NAMES))
    labels = (matrix @ truth > 0).astype(int)
    model = quality.fit(matrix, labels)
    assert np.corrcoef(model.weights, truth)[0, 1] > 0.97
    assert abs((model.score(matrix) < quality.THRESHOLD).mean() - (labels == 0).mean()) < 0.01
    one_class = quality.fit(matrix, np.ones(600))
    assert set(one_class.score(matrix)) == {0.5}


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 0, 1), (None, 1, 0), (5, None, 0), (77, 1, 0), (1, 1, 0), (8, 1, 0), (9, 0, 0)],
                                   "doc_id long, quality int, features int")
    model = quality.learn(documents(spark), labels)
    scores = quality.score(documents(spark), model).collect()
    assert sorted(r["doc_id"] for r in scores) == sorted(i for i, _ in AWKWARD)
    assert all(0 <= r["score"] <= 1 for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] in (3, 4, 5)}) == 1
    kept = quality.keep_good(documents(spark), labels)
    assert kept.columns == documents(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in scores if r["score"] >= quality.THRESHOLD)
    none = quality.learn(documents(spark), labels.filter("quality > 5"))
    assert {r["score"] for r in quality.score(documents(spark), none).collect()} == {0.5}
    assert quality.score(empty(spark), model).count() == 0


def all_pairs(matrix, labels):
    """Weights of the pairwise loss, every pair made."""
    scaled = np.clip((matrix - matrix.mean(axis=0)) / (matrix.std(axis=0) + 1e-9), -4, 4)
    better = (scaled[labels == 1][:, None] - scaled[labels == 0][None]).reshape(-1, matrix.shape[1])
    weights = np.zeros(matrix.shape[1])
    for _ in range(40):
        wrong = 1 / (1 + np.exp(np.clip(better @ weights, -500, 500)))
        slope = -(better * wrong[:, None]).mean(axis=0) + quality.PENALTY * weights
        bend = (better * (wrong * (1 - wrong))[:, None]).T @ better / len(better) + quality.PENALTY * np.eye(len(weights))
        weights -= np.linalg.solve(bend, slope)
    return scaled, weights


def test_fit_uses_all_pairs():
    dice = np.random.default_rng(2)
    matrix = dice.normal(size=(300, len(quality.NAMES)))
    labels = (matrix @ np.linspace(-1, 1, len(quality.NAMES)) + dice.normal(size=300) > .5).astype(int)
    model = quality.fit(matrix, labels)
    scaled, weights = all_pairs(matrix, labels)
    assert np.abs(np.array(model.weights) - weights).max() < 1e-4
    assert abs(model.cut - np.quantile(scaled @ weights, (labels == 0).mean())) < 1e-3


def test_learning_uses_every_labelled_row(spark, monkeypatch):
    """More labelled rows than any bound there was: the model is that of all rows, and ranges are narrowed more than once."""
    monkeypatch.setattr(quality, "FEW", 50)
    monkeypatch.setattr(quality, "BINS", 16)
    words = ["one", "Two", "three.", "FOUR", "5", "||", "six six"]
    dice = np.random.default_rng(3)
    rows = [(i, " ".join(dice.choice(words, dice.integers(2, 9))), int(dice.integers(2))) for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.learn(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    used = [(quality.features(t), y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5]
    assert len(used) > 8192
    expected = quality.fit(np.array([f for f, _ in used]), np.array([y for _, y in used]))
    assert np.allclose(model.mean, expected.mean) and np.allclose(model.scale, expected.scale)
    assert np.allclose(model.weights, expected.weights, atol=1e-6) and abs(model.cut - expected.cut) < 1e-6

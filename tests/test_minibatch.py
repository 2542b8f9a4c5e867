"""Mini-batch training against numpy, and the model store."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.operators import minibatch as MB
from labelkiln.operators.model_store import ModelStore

LABELS = ("one", "two")


def brute_run(draws, docs, dim, per_epoch, size, epochs, rate):
    """Batch by batch with dense vectors."""
    x = {d: np.bincount(idx, minlength=dim) / np.sqrt(max(1, len(idx))) for d, idx in docs.items()}
    w, m, v, t, losses, kept = np.zeros((dim + 1, 2)), 0.0, 0.0, 0, [], []
    for e in range(epochs):
        for lo in range(0, per_epoch, size):
            g = np.zeros(w.shape)
            for i, name in enumerate(LABELS):
                batch = [r for r in draws if r[0] == name and e * per_epoch + lo <= r[1] < e * per_epoch + min(lo + size, per_epoch)]
                rows, y = np.array([np.r_[x[r[2]], 1] for r in batch]), np.array([r[3] for r in batch])
                z = rows @ w[:, i]
                losses.append((e + 1, lo // size, name, float(np.mean(np.logaddexp(0, z) - y * z))))
                g[:, i] = rows.T @ (1 / (1 + np.exp(-z)) - y) / len(batch)
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        kept.append(w)
    return kept, losses


def test_losses_and_weights_equal_numpy(spark):
    rng = np.random.default_rng(3)
    dim, n, size, epochs = 16, 25, 10, 3
    docs = {d: rng.integers(0, dim, rng.integers(0, 9)).tolist() for d in range(12)}
    draws = [(name, k, int(rng.integers(0, 12)), 0) for name in LABELS for k in range(n * epochs)]
    draws = [(name, k, d, int((d + (name == "two")) % 3 == 0)) for name, k, d, _ in draws]
    frame = spark.createDataFrame(draws, "label_name string, draw long, doc_id long, y int").repartition(4)
    features = spark.createDataFrame(list(docs.items()), "doc_id long, idx array<int>")
    batches = MB.batch_rows(frame, features, LABELS, n, size)
    run = MB.train(batches, LABELS, dim, epochs, 3, 0.1)
    want, losses = brute_run(draws, docs, dim, n, size, epochs, 0.1)
    assert len(run.weights) == epochs and [r[:3] for r in run.losses] == [r[:3] for r in losses]
    assert np.allclose([r[3] for r in run.losses], [r[3] for r in losses], atol=1e-9)
    assert all(np.allclose(a, b, atol=1e-8) for a, b in zip(run.weights, want))
    assert run.losses[-1][3] < run.losses[0][3]
    got = {(r["doc_id"], r["label_name"], r["epoch"]): r["p"] for r in MB.score(features, ["doc_id"], run, LABELS).collect()}
    assert len(got) == 12 * 2 * epochs
    for (d, name, e), p in got.items():
        z = np.r_[np.bincount(docs[d], minlength=dim) / np.sqrt(max(1, len(docs[d]))), 1] @ want[e - 1][:, LABELS.index(name)]
        assert p == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-8)


def test_hashed_words(spark):
    got = spark.createDataFrame([("Ab, ab!  C-3",), ("",), (None,)], "t string").select(MB.hashed_words(F.col("t"), 8).alias("i")).collect()
    assert [len(r["i"]) for r in got] == [4, 0, 0] and got[0]["i"][0] == got[0]["i"][1] and all(0 <= i < 8 for i in got[0]["i"])


def test_store_keeps_the_best_and_survives_a_crash(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    assert store.current().collect() == []
    with pytest.raises(KeyError):
        store.load("base", "one")
    w = np.arange(5.0)
    assert store.publish({("base", "one"): (0.6, 1, w), ("base", "two"): (float("nan"), 1, w)}) == 1
    assert store.publish({("base", "one"): (0.6, 2, w + 1)}) == 0  # not strictly better
    assert (store.load("base", "one") == w).all()
    store.write_aside(w + 7)  # a crash between writing and publishing
    assert (store.load("base", "one") == w).all()
    assert store.publish({("base", "one"): (0.7, 3, w + 2), ("tuned", "one"): (0.1, 3, w + 3)}) == 2
    again = ModelStore(spark, str(tmp_path / "store"))
    assert (again.load("base", "one") == w + 2).all() and (again.load("tuned", "one") == w + 3).all()
    assert {(r["encoder"], r["label_name"], r["epoch"], r["version"]) for r in again.current().collect()} == {
        ("base", "one", 3, 2), ("tuned", "one", 3, 1)}

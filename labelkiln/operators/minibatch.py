"""Logistic classifiers trained batch by batch, all labels and epochs in one run.

The training rows are written once, each with the steps that drew it and how often. A
step picks its own rows, computes partial gradients where they are, adds them up by
coordinate before they reach the driver, and moves the weights, which go out again with
the next step. The optimizer's
state lives on over epochs, so epoch e + 1 continues where e ended and nothing is
fitted again. Every label has batches of its own (its own weighted draws); one step
moves all of them.

Features are hashed words: a row's positions (with repeats) and one scale. Weights are
``(dim + 1) x labels`` numbers, the last row being the bias.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from labelkiln.session import cut_lineage


def hashed_words(text: Column, dim: int) -> Column:
    """Positions of a text's words (lower case, letters and digits) among ``dim``."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(dim)).cast("int"))


def batch_rows(draws: DataFrame, features: DataFrame, labels: Sequence[str], per_epoch: int, batch_size: int) -> DataFrame:
    """``draws(label_name, draw, doc_id, y)`` with draws 0 to epochs x per_epoch - 1, and
    ``features(doc_id, idx)`` -> each drawn row once: ``turns`` (step -> list of label, y and
    how often), ``idx``; the last batch of an epoch may be short. Only the narrow draws are
    shuffled for it, not a copy of the words for each draw."""
    steps = -(-per_epoch // batch_size)
    place = F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i)])
    at = F.col("draw") % per_epoch
    step = F.floor(F.col("draw") / per_epoch) * steps + F.floor(at / batch_size)
    times = draws.groupBy("doc_id", step.cast("int").alias("step"), place[F.col("label_name")].alias("label"), "y").agg(
        F.count("*").alias("n"))
    turn = F.struct(F.col("label").cast("int").alias("label"), F.col("y").cast("double").alias("y"), F.col("n").cast("double").alias("n"))
    # a row has at most one entry a step, and in it one turn for each label and class
    each = times.groupBy("doc_id", "step").agg(F.collect_list(turn).alias("turns")).groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("step", "turns"))).alias("turns"))
    rows = each.join(features.select("doc_id", "idx"), "doc_id")
    # a given number of partitions: merged by size, these rows would keep few cores busy
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(rows.repartition(parts, F.xxhash64("doc_id")).select("turns", "idx"), "batches")


#: Cells of (words x weights) looked up at a time.
CELLS = 1 << 20


def pieces(idx: pa.Array, width: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows whose words, ``width`` weights each, are about ``CELLS``
    cells (one row at least)."""
    ends = np.cumsum(idx.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    most, lo = max(1, CELLS // max(1, width)), 0
    while lo < len(idx):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        hi = min(hi, lo + most, len(idx))
        yield lo, hi
        lo = hi


def margins(idx: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Margins of all rows and labels, and (row, position, scale) of the words."""
    sizes = idx.value_lengths().to_numpy(zero_copy_only=False)
    row, at = np.repeat(np.arange(len(idx)), sizes), idx.flatten().to_numpy(zero_copy_only=False)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    z = np.tile(weights[-1], (len(idx), 1)).astype(np.float64)
    some = np.flatnonzero(sizes)
    if len(some):
        z[some] += np.add.reduceat(weights[at], (np.cumsum(sizes) - sizes)[some], axis=0) * scale[some, None]
    return z, row, at, scale


def gradient(idx: pa.Array, doc: np.ndarray, label: np.ndarray, y: np.ndarray, n: np.ndarray,
             weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over turns (row ``doc``, label, y, how often): gradient of the log loss, loss
    and number of turns per label."""
    z, row, at, scale = margins(idx, weights)
    own = z[doc, label]
    p = 1 / (1 + np.exp(-own))
    k = weights.shape[1]
    pull = np.bincount(doc * k + label, n * (p - y), len(idx) * k).reshape(len(idx), k)
    out = np.zeros(weights.shape)
    for i in range(k):
        out[:-1, i] = np.bincount(at, (pull[:, i] * scale)[row], len(weights) - 1)
        out[-1, i] = pull[:, i].sum()
    losses = np.bincount(label, n * (np.logaddexp(0, own) - y * own), k)
    return out, losses, np.bincount(label, n, k)


def _partial(weights: np.ndarray):
    """(turns of the step, idx) rows -> one (cell, value) row per touched cell of a partition's
    gradient; cells behind the weights hold the losses, then the row numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(weights.size + 2 * weights.shape[1])
        for b in batches:
            for lo, hi in pieces(b.column(1), weights.shape[1]):
                turns = b.column(0).slice(lo, hi - lo)
                doc = np.repeat(np.arange(hi - lo), turns.value_lengths().to_numpy(zero_copy_only=False))
                label, y, n = (c.to_numpy(zero_copy_only=False) for c in turns.flatten().flatten())
                total += np.concatenate([g.ravel() for g in gradient(b.column(1).slice(lo, hi - lo), doc, label, y, n, weights)])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "value"])

    return run


@dataclass
class Adam:
    """Moments of the gradient, kept over all steps."""
    rate: float
    step: int = 0
    mean: object = 0.0
    square: object = 0.0

    def move(self, weights: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean = 0.9 * self.mean + 0.1 * g
        self.square = 0.999 * self.square + 0.001 * g * g
        return weights - self.rate * (self.mean / (1 - 0.9**self.step)) / (np.sqrt(self.square / (1 - 0.999**self.step)) + 1e-8)


@dataclass
class Run:
    """Weights after each epoch, and (epoch, step, label, loss) before each step."""
    weights: list[np.ndarray] = field(default_factory=list)
    losses: list[tuple[int, int, str, float]] = field(default_factory=list)


def train(batches: DataFrame, labels: Sequence[str], dim: int, epochs: int, steps: int, rate: float = 0.05) -> Run:
    """``epochs`` x ``steps`` steps over ``batches`` (``batch_rows``); the driver holds the
    weights and their moments, ``(dim + 1) x labels`` numbers each."""
    w, adam, run = np.zeros((dim + 1, len(labels))), Adam(rate), Run()
    k = len(labels)
    for step in range(epochs * steps):
        sums = np.zeros(w.size + 2 * k)
        own = batches.select(F.try_element_at("turns", F.lit(step)).alias("turns"), "idx").filter("turns IS NOT NULL")
        got = (own.mapInArrow(_partial(w), "cell long, value double")
               .groupBy("cell").agg(F.sum("value").alias("value")).toArrow())
        sums[got.column("cell").to_numpy()] = got.column("value").to_numpy()
        g, loss, n = sums[: w.size].reshape(w.shape), sums[w.size : -k], np.maximum(sums[-k:], 1)
        run.losses += [(step // steps + 1, step % steps, name, float(v)) for name, v in zip(labels, loss / n)]
        w = adam.move(w, g / n)
        if step % steps == steps - 1:
            run.weights.append(w)
    return run


def probabilities(rows: DataFrame, keep: Sequence[str], run: Run) -> DataFrame:
    """``rows(keep, idx)`` -> ``keep, ps``: the probabilities of every label, epoch by epoch."""
    weights = np.concatenate(run.weights, axis=1)  # epoch by epoch

    def scored(idx: pa.Array) -> pa.Array:
        p = np.empty((len(idx), weights.shape[1]))
        for lo, hi in pieces(idx, weights.shape[1]):
            p[lo:hi] = 1 / (1 + np.exp(-margins(idx.slice(lo, hi - lo), weights)[0]))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(idx) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))

    return rows.select(*keep, F.arrow_udf(scored, "array<double>")("idx").alias("ps"))


def each_probability(scored: DataFrame, keep: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """``keep, ps`` -> ``keep, label_name, epoch, p``."""
    at = F.col("i")
    return scored.select(*keep, F.posexplode("ps").alias("i", "p")).select(
        *keep, F.element_at(F.array(*[F.lit(x) for x in labels]), (at % len(labels) + 1)).alias("label_name"),
        (F.floor(at / len(labels)) + 1).cast("int").alias("epoch"), "p")


def score(rows: DataFrame, keep: Sequence[str], run: Run, labels: Sequence[str]) -> DataFrame:
    """``rows(keep, idx)`` -> ``keep, label_name, epoch, p`` for every label and epoch,
    in one pass over the rows."""
    return each_probability(probabilities(rows, keep, run), keep, labels)

"""Quality by importance resampling with hashed n-gram models.

Two generative models over hashed n-grams are counted: the target model on good
labelled texts, the raw model on every text. A text's weight is the log ratio of
its probability under the two. The n-grams are single words and word pairs, and
the same over word *shapes* (case, digits and symbols kept, letters folded, with a
mark if the word equals the one before), so that form counts as well as content.

Documents are drawn without replacement by Gumbel top-k: seeded Gumbel noise is
added to each log weight and the k largest stay. k is the number of documents
whose weight is above the level that best parts good from bad labelled texts (of
the half that the target model has not seen), so it follows the documents at hand
and is the same share at any size, unless the caller names a ``share``. Log weights are
sums over all of a text's words, so at ``temperature`` 1 (the default) they outweigh
the noise and the draw keeps what is clearly like the target; a temperature of many
words makes it a random draw in proportion to milder weights. The k-th largest sum is
found by narrowing bins, never by sorting everything in one place. Rows are scored
once and written with their weights.

Labelled texts are read up to ``MAX_LABELLED`` (those of smallest id hash); the raw
model, the weights and the cut cover all documents. Models are two vectors of
``BUCKETS`` numbers.

Edge cases: null and empty texts have weight 0; repeated rows get equal sums and
stay or go together, as do ties at the cut (all stay); a null id is one id;
without labels of both kinds everything stays; an empty table gives no rows;
further columns are kept by ``resample`` and not read otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import WordTable, segment_sums, spare, word_blocks
from labelkiln.session import cut_lineage

#: Buckets of the n-gram models, bound on labelled rows, smoothing count per bucket.
BUCKETS, MAX_LABELLED, SMOOTH = 1 << 15, 20_000, 1.0
#: Bins of a narrowing step, and of the level's search.
BINS = 4096

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: str) -> str:
    """Runs of capitals, other letters, digits; symbols as they are, at most two in a row."""
    s = re.sub(r"[0-9]+", "9", word)
    s = "".join("X" if c.isupper() else "x" if c.isalpha() else c for c in s)
    return re.sub(r"(.)\1+", r"\1\1", s)


def _codes(words: list[str]) -> np.ndarray:
    """Hashes of each word in lower case and of its shape."""
    low = np.fromiter((xxhash.xxh64_intdigest(w.lower(), 1) for w in words), np.uint64, len(words))
    shape = np.fromiter((xxhash.xxh64_intdigest(_shape(w), 2) for w in words), np.uint64, len(words))
    return np.stack([low, shape], axis=1)


class Grams:
    """N-gram buckets of texts; the hashes of words seen are remembered."""

    def __init__(self):
        self.table = WordTable(2, np.uint64)

    def buckets(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(starts, buckets)`` per run of texts; ``buckets`` has four columns per
        word: word, shape, word pair and shape pair (the pair with the word before,
        a mark at the beginning)."""
        for starts, which, distinct in word_blocks(texts):
            codes = self.table.get(distinct, _codes)[which]
            begin = np.zeros(len(which), bool)
            begin[starts[:-1][starts[:-1] < len(which)]] = True
            same = np.zeros(len(which), bool)
            same[1:] = which[1:] == which[:-1]
            same &= ~begin
            word, shape = codes[:, 0], codes[:, 1] + same.astype(np.uint64)
            out = np.empty((len(which), 4), np.int64)
            for i, x in enumerate((word, shape)):
                before = np.r_[x[:1], x[:-1]]
                before[begin] = 0
                for j, z in ((i, x), (i + 2, (before * _MIX) ^ (x + np.uint64(i)))):
                    z = (z ^ (z >> np.uint64(33))) * _MIX
                    out[:, j] = (z >> np.uint64(40)) % np.uint64(BUCKETS // 4) + np.uint64(j * (BUCKETS // 4))
            yield starts, out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a partition's texts."""
    grams, total = shared_grams(), np.zeros(BUCKETS, np.int64)
    for b in batches:
        for _, buckets in grams.buckets(b.column(0)):
            total += np.bincount(buckets.ravel(), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])


def gram_counts(texts: DataFrame, text_col: str) -> np.ndarray:
    """Counts per bucket over all texts (``BUCKETS`` numbers on the driver)."""
    counted = texts.select(text_col).mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS)
    for row in counted.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def log_weight(text: Column | str, ratio: np.ndarray) -> Column:
    """Sum of the buckets' log ratios over a text's n-grams."""

    def udf(texts: pa.Array) -> pa.Array:
        grams = shared_grams()
        parts = [segment_sums(ratio[buckets].sum(axis=1), starts) for starts, buckets in grams.buckets(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(udf, "double")(text)


@cache
def shared_grams() -> Grams:
    """One memory of words per worker."""
    return Grams()


def gumbel(id_col: Column, seed: int) -> Column:
    """Seeded standard Gumbel noise of an id."""
    h = F.xxhash64(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("null")))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    seed: int) -> DataFrame:
    """``(id, text, y)`` of at most MAX_LABELLED labelled documents, one row of each."""
    y = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    some = y.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(MAX_LABELLED)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    met = texts.join(F.broadcast(some.distinct()), "id")  # at most MAX_LABELLED ids; one text of each, however often it is repeated
    return met.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


class Resampler:
    """A fitted model: ``ratio`` (log ratio per bucket) and ``level``."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", seed: int = 11, share: float | None = None, temperature: float = 1.0):
        self.id_col, self.text_col, self.seed, self.share, self.temperature = id_col, text_col, seed, share, temperature
        sample = cut_lineage(labelled_sample(docs, labels, id_col, text_col, label_col, seed), "labelled")
        half = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(2)) == 0
        target = gram_counts(sample.filter("y = 1").filter(half), "text")
        raw = gram_counts(docs, text_col)
        self.ratio = np.log((target + SMOOTH) / (target + SMOOTH).sum()) - np.log((raw + SMOOTH) / (raw + SMOOTH).sum())
        judged = sample.filter(~half).select("y", log_weight("text", self.ratio).alias("w")).toPandas()  # bounded
        self.level = self._level(judged["w"].to_numpy(), judged["y"].to_numpy())

    @staticmethod
    def _level(w: np.ndarray, y: np.ndarray) -> float:
        """The weight that parts the labels with the fewest errors (the middle of
        the widest gap among the best cuts); minus infinity without both labels."""
        if not ((y == 1).any() and (y == 0).any()):
            return float("-inf")
        order = np.argsort(w, kind="stable")
        w, good = w[order], (y[order] == 1)
        # cut before position i: good ones below it and bad ones from it on are errors
        errors = np.r_[0, np.cumsum(good)] + np.r_[np.cumsum((~good)[::-1])[::-1], 0]
        edges = np.r_[w[0] - 1, w, w[-1] + 1]
        gap = edges[1:] - edges[:-1]
        best = max(np.flatnonzero(errors == errors.min()), key=lambda i: gap[i])
        return float((edges[best] + edges[best + 1]) / 2)

    def weight(self) -> Column:
        """Log weight of a row."""
        return log_weight(F.col(f"`{self.text_col}`"), self.ratio)

    def perturbed(self, weight: Column) -> Column:
        """Log weight over the temperature, plus the row's Gumbel noise."""
        return weight / self.temperature + gumbel(F.col(f"`{self.id_col}`"), self.seed)

    def cut(self, weighted: DataFrame) -> float:
        """The k-th largest ``_drawn``; k is ``share`` of the rows, or else the number of
        weights above the level."""
        k = (weighted.filter(F.col("_weight") > self.level).count() if self.share is None
             else round(self.share * weighted.count()))
        span = weighted.agg(F.min("_drawn").alias("lo"), F.max("_drawn").alias("hi")).first()
        lo, hi = span["lo"], span["hi"]
        if not k:
            return float("inf")
        above = 0  # rows above hi
        while True:
            step = (hi - lo) / BINS
            if step <= 0 or lo + step == lo:
                return lo
            bins = F.least(F.floor((F.col("_drawn") - lo) / step), F.lit(BINS - 1))
            got = {r["b"]: (r["n"], r["lo"], r["hi"]) for r in weighted.filter(F.col("_drawn").between(lo, hi))
                   .groupBy(bins.alias("b")).agg(F.count("*").alias("n"), F.min("_drawn").alias("lo"),
                                                 F.max("_drawn").alias("hi")).collect()}  # at most BINS rows
            for b in sorted(got, reverse=True):
                n, low, high = got[b]
                if above + n >= k:
                    break
                above += n
            if above + n == k or low == high:
                return low
            lo, hi = low, high


def draw(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per document: ``id_col``, ``log_weight``, ``drawn`` and ``kept``."""
    model = Resampler(docs, labels, id_col, **how)
    weighted = cut_lineage(docs.select(F.col(f"`{id_col}`"), model.weight().alias("_weight"))
                           .withColumn("_drawn", model.perturbed(F.col("_weight"))), "weights")
    kept = F.col("_drawn") >= model.cut(weighted)
    return weighted.select(F.col(f"`{id_col}`"), F.col("_weight").alias("log_weight"), F.col("_drawn").alias("drawn"),
                           kept.alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The drawn documents, with the columns of ``docs``."""
    model = Resampler(docs, labels, id_col, **how)
    weight, drawn = spare(docs.columns, "_weight"), spare(docs.columns, "_drawn")
    # rows are scored once and written with their weights
    scored = cut_lineage(docs.withColumn(weight, model.weight()).withColumn(drawn, model.perturbed(F.col(weight))), "weights")
    cut = model.cut(scored.select(F.col(weight).alias("_weight"), F.col(drawn).alias("_drawn")))
    return scored.filter(F.col(drawn) >= cut).select(*[F.col(f"`{c}`") for c in docs.columns])

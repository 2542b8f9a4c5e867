"""Substring removal: word windows that also start in an earlier document.

A window is ``2 * half`` consecutive words. Level by level: windows of ``half``
words that repeat are extended to twice that length, and only those are hashed
and compared there; without candidates the work ends.

Level 1 does not ship every half window. Of the half windows inside a whole
window the one with the smallest hash is its *seed*; equal windows have equal
seeds at equal places, so nothing is lost, and neighbouring windows mostly share
their seed: the run of windows with one seed is one row (about 7 % of the
words). A seed found in one document only ends there. A repeated seed whose runs
are all equal settles all of them at once: the smallest document id owns the
run, every other occurrence is removed. Where one seed has different runs, each
distinct run has one owner too, and only the owners' runs are extended to whole
windows of twice the length, compared by 128-bit hashes.

Everything is keyed by hashes and pre-aggregated minima; no group is collected,
no pairs are formed. A document's own removed ranges are gathered by document.

Edge cases: null text has no words; texts shorter than a window are kept;
documents with a null id keep everything and remove nothing; rows with equal ids
do not remove each other, ranges of different texts under one id stay apart;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import utf8_words
from labelkiln.session import cut_lineage

#: Words hashed together, word hashes remembered per worker.
BLOCK, MEMO_WORDS = 1 << 18, 1 << 17
#: Bits of a position in a block (a block and the overlap of a cut text fit).
AT_BITS = np.uint64(20)


class _WordHashes(dict):
    """XXH64 of words, remembered (emptied when full)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray, y: np.ndarray, lane: int = 0) -> np.ndarray:
    """A hash of the ordered pair, by the usual 64-bit finaliser."""
    z = x * np.uint64(0x9E3779B97F4A7C15 + 2 * lane) + (y ^ (y >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each position, by doubling."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, out, done = words, 1, None, 0
    while True:
        if length & size:
            out = power[:n] if out is None else _mix(out, power[done : done + n], lane)
            done += size
        if done == length:
            return out
        power = _mix(power[:-size], power[size:], lane)
        size *= 2


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, low = 1, x
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(low[:n], low[width - size : width - size + n])


def seed_runs(words: np.ndarray, text_no: np.ndarray, half: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one seed: first window, number of windows, seed
    hash, run hash. ``text_no`` tells which text a word belongs to."""
    none = np.zeros(0, np.int64)
    h = window_hashes(words, half)
    if len(words) < 2 * half:
        return none, none, none, none
    whole = _mix(h[: len(h) - half], h[half:])
    low_bits = (np.uint64(1) << AT_BITS) - np.uint64(1)
    marked = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64)
    at = (_sliding_min(marked, half + 1) & low_bits).astype(np.int64)
    ok = np.flatnonzero(text_no[: len(whole)] == text_no[2 * half - 1 :])
    if not len(ok):
        return none, none, none, none
    at = at[ok]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    stops = np.r_[starts[1:], len(ok)] - 1
    first, last, at = ok[starts], ok[stops], at[starts]
    shape = ((at - first) * (2 * half) + (last - first)).astype(np.uint64)
    run = _mix(_mix(whole[first], whole[last]), shape)
    return first, last - first + 1, h[at].view(np.int64), run.view(np.int64)


def _blocks(texts: Iterator, half: int) -> Iterator[list]:
    """Groups of (key, offset, words) of up to about BLOCK words; a longer text
    is cut into pieces that overlap by a window less one word."""
    held, n = [], 0
    for key, words in texts:
        for at in range(0, max(len(words) - 2 * half + 1, 0), BLOCK):
            piece = words[at : at + BLOCK + 2 * half - 1]
            if n and n + len(piece) > BLOCK:
                yield held
                held, n = [], 0
            held.append((key, at, piece))
            n += len(piece)
    if held:
        yield held


def run_type(half: int) -> str:
    """Type of a run's number of windows, of which there are at most ``half + 1``."""
    return "byte" if half < 127 else "int"


def _runs(half: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()

        def texts():
            for b in batches:
                for i, c, t in zip(*b.columns):
                    yield (i.as_py(), c.as_py()), utf8_words(t.as_py())

        for held in _blocks(texts(), half):
            sizes = np.array([len(w) for _, _, w in held])
            no = np.repeat(np.arange(len(held)), sizes)
            begin = np.cumsum(sizes) - sizes
            words = np.concatenate([hashes.of(w) for _, _, w in held])
            first, n, seed, which = seed_runs(words, no, half)
            text = no[first]
            offset = np.array([o for _, o, _ in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array([k[0] for k, _, _ in held], np.int64)[text]),
                 pa.array(np.array([k[1] for k, _, _ in held], np.int64)[text]), pa.array(seed), pa.array(which),
                 pa.array((first - begin[text] + offset[text]).astype(np.int32)), pa.array(n.astype(np.int8 if run_type(half) == "byte" else np.int32))],
                ["id", "content", "seed", "run", "start", "n"])

    return run


def _windows(half: int):
    """Hashes of the whole windows in the given runs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()

        def texts():
            for b in batches:
                for i, c, t, spans in zip(*b.columns):
                    words = utf8_words(unpack(t.as_py()))
                    for span in spans.as_py():
                        start, n = span["start"], span["n"]
                        yield (i.as_py(), c.as_py(), start), words[start : start + n + 2 * half - 1]

        for held in _blocks(texts(), half):
            sizes = np.array([len(w) for _, _, w in held])
            no = np.repeat(np.arange(len(held)), sizes)
            begin = np.cumsum(sizes) - sizes
            words = np.concatenate([hashes.of(w) for _, _, w in held])
            ok = np.flatnonzero(no[: len(words) - 2 * half + 1] == no[2 * half - 1 :])
            text = no[ok]
            lanes = [pa.array(window_hashes(words, 2 * half, lane)[ok].view(np.int64)) for lane in (1, 2)]
            keys = [np.array([k[j] for k, _, _ in held], np.int64)[text] for j in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*lanes, pa.array(keys[0]), pa.array(keys[1]),
                 pa.array((keys[2] + ok - begin[text]).astype(np.int32))], ["w1", "w2", "id", "content", "start"])

    return run


def pack(text: Column) -> Column:
    """Texts compressed for a shuffle (null stays null)."""

    def udf(texts: pa.Array) -> pa.Array:
        c = zstandard.ZstdCompressor(level=1)
        return pa.array([None if t is None else c.compress(t.encode("utf-8", "surrogatepass"))
                         for t in (x.as_py() for x in texts)], pa.binary())

    return F.arrow_udf(udf, "binary")(text)


def unpack(data: bytes | None) -> str | None:
    return None if data is None else zstandard.decompress(data).decode("utf-8", "surrogatepass")


def _cut(width: int):
    """Removes the windows that begin at the given (start, n) ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            n_words, n_gone, spans, kept = [], [], [], []
            for t, ranges in zip(b.column(1), b.column(2)):
                words = utf8_words(unpack(t.as_py()))
                n_words.append(len(words))
                removed = []
                for r in sorted((r["start"], r["start"] + r["n"] - 1 + width) for r in ranges.as_py() or []):
                    if removed and r[0] <= removed[-1][1]:
                        removed[-1][1] = max(removed[-1][1], r[1])
                    else:
                        removed.append([*r])
                stay, at = [], 0
                for start, stop in removed:
                    stay += words[at:start]
                    at = stop
                stay += words[at:]
                n_gone.append(len(words) - len(stay))
                spans.append([{"start": x, "stop": y} for x, y in removed])
                kept.append(b" ".join(stay).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                 pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "removed", "kept"])

    return run


def repeated_windows(docs: DataFrame, half: int) -> DataFrame:
    """``docs(id, content, text)`` -> ``(id, content, start, n)``: windows from
    ``start`` on, ``n`` in a row, that also start in a document of smaller id."""
    level1 = cut_lineage(docs.filter("id is not null").select("id", "content", "text").mapInArrow(
        _runs(half), f"id long, content long, seed long, run long, start int, n {run_type(half)}"), "seeds")
    seeds = (level1.groupBy("seed").agg(F.min("id").alias("low"), F.max("id").alias("high"),
                                        F.min("run").alias("run1"), F.max("run").alias("run2"))
             .filter("low < high").select("seed", "low", (F.col("run1") == F.col("run2")).alias("settled")))
    repeated = cut_lineage(level1.join(seeds, "seed").filter("not settled or id > low"), "repeated")
    copies = repeated.filter("settled")
    several = repeated.filter("not settled").drop("low")
    owned = cut_lineage(several.join(several.groupBy("seed", "run").agg(F.min("id").alias("owner")), ["seed", "run"])
                        .select("id", "content", "start", "n", "owner"), "owned")
    out = copies.select("id", "content", "start", "n").union(
        owned.filter("id > owner").select("id", "content", "start", "n"))
    candidates = owned.filter("id = owner")
    if candidates.isEmpty():  # no window is left to extend
        return out
    spans = candidates.groupBy("id", "content").agg(
        F.collect_list(F.struct("start", F.col("n").cast("int").alias("n"))).alias("spans"))
    packed = docs.select("id", "content", pack(F.col("text")).alias("packed")).dropDuplicates(["id", "content"])
    level2 = cut_lineage(packed.join(spans, ["id", "content"]).mapInArrow(
        _windows(half), "w1 long, w2 long, id long, content long, start int"), "windows")
    first = level2.groupBy("w1", "w2").agg(F.min("id").alias("owner"), F.max("id").alias("high")).filter("owner < high")
    later = level2.join(first, ["w1", "w2"]).filter("id > owner")
    return out.union(later.select("id", "content", "start", F.lit(1).cast(run_type(half)).alias("n")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_removed``, ``removed``
    (word ranges), ``kept`` (the kept words joined by one space)."""
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("content"),
                       F.col(text_col).alias("text"))
    found = repeated_windows(rows, window // 2)
    ranges = found.groupBy("id", "content").agg(
        F.collect_list(F.struct("start", F.col("n").cast("int").alias("n"))).alias("ranges"))
    joined = rows.select("id", "content", pack(F.col("text")).alias("packed")).join(ranges, ["id", "content"], "left")
    return joined.select("id", "packed", "ranges").mapInArrow(
        _cut(window), "id long, n_words long, n_removed long, removed array<struct<start:int,stop:int>>, kept string"
    ).withColumnRenamed("id", id_col)

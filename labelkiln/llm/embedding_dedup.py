"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction on the sphere; a vector passes the filters whose inner
product with it reaches ``alpha``. Directions are structured random product codes:
after a random rotation the vector is cut into blocks, each block has its own few
random unit codewords, and a direction is one codeword per block. ``TURNS``
independent rotations are used. The passing directions of a vector are listed block
by block, dropping every partial sum that the best codewords of the remaining blocks
cannot lift to ``alpha``, so the whole code is never gone through. Vectors meet by
(label, filter) and are verified by their cosine in double precision.

The number of directions follows the largest label's number of different vectors,
so that a filter holds about ``MEET`` of them whatever the size. ``alpha`` is the
largest value at which simulated random pairs at exactly the wanted cosine share a
filter with probability ``RECALL``; random rotations make that independent of the
data, and closer pairs are found more surely.

A pair that passes several common filters is counted in the first of them only, so
link numbers are exact for the pairs found, and no pair is written: a filter hands on
each vector's number of links there and one link to the smallest member of its
component there. Equal vectors of a label are one entry with a count. Filters of more
than ``chunk_rows`` entries are dealt into chunks and verified as pairs of chunks.

Edge cases: a null label links with nothing, nor do vectors that are null, empty, all
zero or hold null or non-finite components; only vectors of one length are compared;
rows with a null id are rows of their own (a component of null ids alone has a null
id); repeated rows link with each other; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import lookup
from labelkiln.llm.components import connected_components
from labelkiln.session import cut_lineage

#: Independent rotations, vectors of a label that a filter should hold, wanted recall of pairs at the border.
TURNS, MEET, RECALL = 12, 64, 0.98
#: Codewords of a block beyond which a code gets one block more, simulated pairs, partial sums extended together.
MOST_WORDS, PAIRS, SUMS = 4096, 1000, 1 << 13
#: Rows verified together, pairs whose filters are compared together.
BLOCK_ROWS, COMPARED = 1 << 15, 1 << 12
#: Cosines this near the border are computed again, vector by vector.
SLACK = 1e-9


class Caps:
    """The filters for vectors of one length."""

    def __init__(self, dim: int, words: int, blocks: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.blocks = min(blocks, dim)
        self.cuts = [dim * i // self.blocks for i in range(self.blocks + 1)]
        self.words, self.rotate, self.codes = words, [], []
        for _ in range(TURNS):
            self.rotate.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
            made = [rng.standard_normal((words, b - a)) for a, b in zip(self.cuts, self.cuts[1:])]
            self.codes.append([c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(self.blocks) for c in made])

    def passed(self, x: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that unit vectors pass, by row and filter."""
        rows, names = [], []
        for turn, (rotate, codes) in enumerate(zip(self.rotate, self.codes)):
            y = x @ rotate
            sums = [y[:, a:b] @ c.T for a, b, c in zip(self.cuts, self.cuts[1:], codes)]
            rest = np.zeros(len(x))  # what the blocks still to come can add at most
            reach = [rest]
            for s in reversed(sums[1:]):
                reach.append(rest := rest + s.max(axis=1))
            who, partial, name = np.arange(len(x)), np.zeros(len(x)), np.full(len(x), turn, np.int64)
            for s, rest in zip(sums, reversed(reach)):
                kept = []
                for at in range(0, len(who), SUMS):
                    w = who[at : at + SUMS]
                    total = partial[at : at + SUMS, None] + s[w]
                    i, j = np.nonzero(total >= (alpha - rest[w])[:, None])
                    kept.append((w[i], total[i, j], name[at : at + SUMS][i] * self.words + j))
                who, partial, name = (np.concatenate(k) for k in zip(*kept)) if kept else (who, partial, name)
            rows.append(who)
            names.append(name)
        rows, names = np.concatenate(rows), np.concatenate(names)
        order = np.lexsort((names, rows))
        return rows[order], names[order]


@lru_cache(maxsize=16)
def _code(dim: int, words: int, blocks: int, seed: int) -> Caps:
    return Caps(dim, words, blocks, seed)


@lru_cache(maxsize=16)
def caps(dim: int, words: int, blocks: int, cosine: float, seed: int) -> tuple[Caps, float]:
    """Filters and the threshold at which simulated pairs at ``cosine`` are found."""
    made = _code(dim, words, blocks, seed)
    if dim == 1:  # equal directions only: they pass the same filters
        return made, 0.0
    rng = np.random.default_rng(seed)
    a, b = unit(rng.standard_normal((PAIRS, dim))), rng.standard_normal((PAIRS, dim))
    b = cosine * a + np.sqrt(1 - cosine**2) * unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    names = TURNS * made.words**made.blocks

    def enough(alpha: float) -> bool:
        (i, f), (j, g) = made.passed(a, alpha), made.passed(b, alpha)
        return len(np.unique(np.intersect1d(i * names + f, j * names + g) // names)) >= RECALL * PAIRS

    step = 0.1 / np.sqrt(dim)  # from above, as low thresholds list almost all filters
    low = 1.0
    while low > -1 and not enough(low):
        low -= step
    for _ in range(4):
        step /= 2
        low += step if enough(low + step) else 0.0
    return made, low


def code_size(entries: int) -> tuple[int, int]:
    """Codewords per block and blocks for labels of at most ``entries`` vectors."""
    directions = max(1.0, 14 * entries / MEET / TURNS)
    blocks = 2
    while directions ** (1 / blocks) > MOST_WORDS:
        blocks += 1
    return max(6, round(directions ** (1 / blocks))), blocks


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, of any magnitude."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _filters_udf(words: int, blocks: int, cosine: float, seed: int, known: dict[int, float]):
    def udf(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        lists: list = [None] * len(vectors)
        for dim in np.unique(sizes).tolist():
            here = np.flatnonzero(sizes == dim)
            if dim in known:
                made, alpha = _code(dim, words, blocks, seed), known[dim]
            else:
                made, alpha = caps(dim, words, blocks, cosine, seed)
            row, name = made.passed(unit(_rows_of(vectors.take(pa.array(here)), dim)), alpha)
            ends = np.searchsorted(row, np.arange(len(here) + 1))
            for i, a, b in zip(here.tolist(), ends, ends[1:]):
                lists[i] = name[a:b]
        return pa.array(lists, pa.list_(pa.int64()))

    return F.arrow_udf(udf, "array<long>")


def first_shared(lists: np.ndarray, i: np.ndarray, j: np.ndarray, name: int) -> np.ndarray:
    """Whether ``name`` is the first filter that rows i and j both pass. ``lists`` holds
    each row's filters in rising order, -1 behind the last."""
    first = (lists[i, 0] == name) | (lists[j, 0] == name)
    open_ = np.flatnonzero(~first)
    for at in range(0, len(open_), COMPARED):
        part = open_[at : at + COMPARED]
        a, b = lists[i[part]], lists[j[part]]
        earlier = (a[:, :, None] == b[:, None, :]) & ((a >= 0) & (a < name))[:, :, None]
        first[part] = ~earlier.any(axis=(1, 2))
    return first


def smallest_members(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (smallest position) of ``n`` nodes under links (i, j)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before, label)  # a node's old label follows its new one
        label = label[label]
        if (label == before).all():
            return label


def _verify(cosine: float):
    """Sorted rows (label, name, c1, c2, chunk, dim, k1, k2, copies, vec, filters), one
    run per filter and pair of chunks -> (k1, k2, n, r1, r2): an entry's links there and
    the smallest entry of its component there."""

    def links(x: np.ndarray, lists: np.ndarray, chunk: np.ndarray, c1: int, c2: int,
              name: int) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        u, two = unit(x), c1 != c2
        left, right = np.flatnonzero(chunk == c1), np.flatnonzero(chunk == c2)
        step = max(1, (1 << 20) // max(1, len(right)))
        for at in range(0, len(left), step):
            rows = left[at : at + step]
            a, b = np.nonzero(u[rows] @ u[right].T >= cosine - SLACK)
            i, j = rows[a], right[b]
            if not two:
                i, j = i[i < j], j[i < j]
            near = np.flatnonzero(first_shared(lists, i, j, name))
            i, j = i[near], j[near]
            exact = (u[i] * u[j]).sum(axis=1) >= cosine
            found.append((i[exact], j[exact]))
        return tuple(np.concatenate(f) for f in zip(*found))

    def answer(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        label = rows.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        key = np.stack([label, *(rows.column(c).to_numpy() for c in ("name", "c1", "c2", "dim"))], axis=1)
        k1, k2, copies, chunk = (rows.column(c).to_numpy() for c in ("k1", "k2", "copies", "chunk"))
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(key)].tolist()):
            if b - a < 2:
                continue
            own = rows.slice(a, b - a)
            x = _rows_of(own.column("vec").combine_chunks(), int(key[a, 4]))
            given = own.column("filters").combine_chunks()
            sizes = given.value_lengths().to_numpy()
            lists = np.full((b - a, sizes.max()), -1, np.int64)
            lists[np.arange(lists.shape[1]) < sizes[:, None]] = given.flatten().to_numpy()
            i, j = links(x, lists, chunk[a:b], int(key[a, 2]), int(key[a, 3]), int(key[a, 1]))
            if not len(i):
                continue
            n = np.zeros(b - a, np.int64)
            np.add.at(n, i, copies[a:b][j])
            np.add.at(n, j, copies[a:b][i])
            root, some = smallest_members(b - a, i, j), n > 0
            for o, v in zip(out, (k1[a:b][some], k2[a:b][some], n[some], k1[a:b][root[some]], k2[a:b][root[some]])):
                o.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], ["k1", "k2", "n", "r1", "r2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:  # keep the last run back, it may go on
                rows = pa.Table.from_batches(held).combine_chunks()
                key = ("label", "name", "c1", "c2", "dim")
                tail = [rows.column(c)[-1] for c in key]
                cut = rows.num_rows
                while cut and all(rows.column(c)[cut - 1] == t for c, t in zip(key, tail)):
                    cut -= 1
                if cut:
                    yield from answer(rows.slice(0, cut))
                held, n = rows.slice(cut).to_batches(), rows.num_rows - cut
        if held:
            yield from answer(pa.Table.from_batches(held).combine_chunks())

    return run


def _valid(vectors: Column) -> Column:
    finite = F.forall(vectors, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vectors.isNotNull() & finite & F.exists(vectors, lambda v: v != 0), F.lit(False))


def link_counts(entries: DataFrame, cosine: float, chunk_rows: int = 2048, seed: int = 11) -> DataFrame:
    """``entries(label string, k1, k2, copies, vec)``, one per different vector of a
    label -> ``k1``, ``k2``, ``n``, ``r1``, ``r2``: per filter an entry's links counted
    there (copies as many) and the smallest entry it is connected with there."""
    largest = entries.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    usual = entries.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count")).first()
    words, blocks = code_size(largest)
    # the threshold of the usual length is found once, here; workers find those of odd lengths
    known = {usual["dim"]: caps(usual["dim"], words, blocks, cosine, seed)[1]} if usual else {}
    index = cut_lineage(entries.withColumn("filters", _filters_udf(words, blocks, cosine, seed, known)("vec")), "filters")
    met = index.select("label", F.explode("filters").alias("name"), F.size("vec").alias("dim"))
    big = cut_lineage(met.groupBy("label", "name", "dim").count().filter(F.col("count") > chunk_rows).select(
        "label", "name", "dim", F.ceil(F.col("count") / chunk_rows).cast("int").alias("chunks")), "large-filters")
    sent = index.select("*", F.explode("filters").alias("name"), F.size("vec").alias("dim"))
    dealt = (sent.join(big, ["label", "name", "dim"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("chunk", F.pmod(F.xxhash64("k1", "k2"), "chunks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("label", "name", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"),
                     "chunk", "dim", "k1", "k2", "copies", "vec", "filters"))
    key = ["label", "name", "c1", "c2", "dim"]
    return (dealt.repartition(*key).sortWithinPartitions(*key, "chunk")
            .mapInArrow(_verify(cosine), "k1 long, k2 long, n long, r1 long, r2 long"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", **how) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable), ``kept`` (it is the own id)."""
    label, vec = F.col(label_col).cast("string"), F.col(vec_col)
    takes_part = label.isNotNull() & _valid(vec)
    rows = cut_lineage(vectors.select(
        F.col(id_col).alias("id"), label.alias("label"), F.when(takes_part, vec).alias("vec"),
        F.when(takes_part, F.xxhash64(label, vec)).alias("k1"), F.when(takes_part, F.xxhash64(vec, label)).alias("k2")), "vectors")
    entries = cut_lineage(rows.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.min("id").alias("low"), F.count("*").alias("copies"), F.first("vec").alias("vec")), "entries")
    found = cut_lineage(link_counts(entries.drop("low"), cosine, **how).groupBy("k1", "k2", "r1", "r2").agg(
        F.sum("n").alias("n")), "links")
    roots = connected_components(found.select(F.struct("k1", "k2").alias("u"),
                                              F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias("v")))
    own = F.struct("k1", "k2")
    rooted = cut_lineage(entries.select("k1", "k2", "low", "copies").join(
        roots.select("node.*", "root"), ["k1", "k2"], "left").withColumn("root", F.coalesce("root", own)), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    counts = found.groupBy("k1", "k2").agg(F.sum("n").alias("n"))
    told = (lookup(rooted, lowest, ["root"]).join(counts, ["k1", "k2"], "left")
            .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id",
                    F.lit(True).alias("grouped")))
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("id"))
    return lookup(rows.drop("vec", "label"), told, ["k1", "k2"]).select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))

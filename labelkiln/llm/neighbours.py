"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` hash tables cuts ``width``-wide cells along ``hashes`` Gaussian
projections. A query visits its own bucket and then the perturbed buckets in the
order of estimated success (sum of squared distances to the crossed cell walls,
smallest first), ``probes`` buckets per table. Vectors of the visited buckets are
ranked by exact Euclidean distance in double precision, and the tables' results
are merged.

Width and number of probes are fitted on at most ``FIT_ROWS`` vectors (those of
smallest id hash): the width follows the distance of the k-th neighbour, the
probes are doubled until the sample's own search reaches ``FIT_RECALL``; where
``MOST_PROBES`` of them do not, there are more tables or fewer hashes. The
number of hashes grows with the logarithm of the table. Every vector is indexed.

Equal vectors are one entry with its ``k + 1`` smallest ids, which are all that can
appear in a result. Buckets of more than ``CHUNK`` entries are dealt into chunks that
each probe visits. All chunks are dealt over as many parts as there are shuffle
partitions; a query's vector is sent to a part once, with the list of the chunks it
visits there, and a part returns each query's ``k + 1`` best, never the pairs. A query
left with fewer than k neighbours is compared with all vectors, in blocks of
``FALLBACK`` queries.

Edge cases: vectors that are null, empty, all zero or hold null or non-finite
components, those of another than the most frequent length, and null ids take no
part; ties go to the smaller id; rows repeating id and vector count once; a query
is never its own neighbour; fewer than k candidates give them all; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.session import cut_lineage

#: Fit: sample rows and queries, wanted recall on the sample, most probes per table, most tables.
FIT_ROWS, FIT_QUERIES, FIT_RECALL, MOST_PROBES, MOST_TABLES = 2048, 64, 0.97, 4096, 16
#: Entries of a bucket handled together, queries compared with everything at a time, distances at a time.
CHUNK, FALLBACK, DISTANCES = 4096, 4096, 1 << 20
#: Share of the squared norms by which a matrix product may be off (rounding is far below it).
SLACK = 1e-9


class Tables:
    """Projections and cells of all tables, and the visiting order."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.project = rng.standard_normal((tables, dim, hashes))
        self.offset = rng.uniform(0, width, (tables, hashes))
        self.salt = rng.integers(1, 2**63, hashes, dtype=np.uint64) | np.uint64(1)
        self.width, self.n, self.hashes = width, tables, hashes

    def cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers, and the place inside the cell (0 to 1), per projection."""
        at = (x @ self.project[table] + self.offset[table]) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def key(self, cell: np.ndarray) -> np.ndarray:
        """One long per bucket; buckets that share a key only add candidates."""
        z = (cell.astype(np.uint64) * self.salt).sum(axis=-1, dtype=np.uint64)
        z = (z ^ (z >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (z ^ (z >> np.uint64(29))).view(np.int64)

    def visit(self, cell: np.ndarray, inside: np.ndarray, probes: int) -> np.ndarray:
        """Keys of the first ``probes`` buckets of one query, likeliest first."""
        k = self.hashes
        cost = np.r_[inside**2, (1 - inside) ** 2]
        order = np.argsort(cost, kind="stable")
        cost, axis, step = cost[order], order % k, np.where(order < k, -1, 1)
        moves = [()]
        heap = [(cost[0], (0,))]
        while heap and len(moves) < probes:
            total, chosen = heapq.heappop(heap)
            if len({*axis[list(chosen)].tolist()}) == len(chosen):
                moves.append(chosen)
            last = chosen[-1] + 1
            if last < 2 * k:  # shift the last wall to the next nearest, or cross that one as well
                heapq.heappush(heap, (total - cost[last - 1] + cost[last], (*chosen[:-1], last)))
                heapq.heappush(heap, (total + cost[last], (*chosen, last)))
        cells = np.repeat(cell[None], len(moves), axis=0)
        for row, chosen in enumerate(moves):
            for i in chosen:
                cells[row, axis[i]] += step[i]
        return self.key(cells)


def distances(queries: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, by differences."""
    out = np.empty((len(queries), len(x)))
    rows = max(1, DISTANCES // max(1, x.shape[0] * x.shape[1]))
    for at in range(0, len(queries), rows):
        out[at : at + rows] = np.sqrt(((queries[at : at + rows, None] - x[None]) ** 2).sum(axis=2))
    return out


def sample_recall(made: Tables, probes: int, sample: np.ndarray, near: np.ndarray) -> float:
    """Share of the ``near`` sample rows of the first queries that a search visits."""
    hit = np.zeros((len(near), len(sample)), bool)
    for t in range(made.n):
        cell, inside = made.cells(sample, t)
        keys = made.key(cell)
        for q in range(len(near)):
            hit[q] |= np.isin(keys, made.visit(cell[q], inside[q], probes))
    return float(np.take_along_axis(hit, near, axis=1).mean())


def fit(sample: np.ndarray, total: int, k: int, tables: int, seed: int) -> tuple[Tables, int]:
    """Tables and probes for ``total`` vectors of which ``sample`` is a part. Probes are
    doubled up to ``MOST_PROBES``; where that does not reach ``FIT_RECALL``, tables are
    doubled up to ``MOST_TABLES``, then hashes are taken away one by one, so that buckets
    grow: with the last one a search visits all cells, so the recall is always reached."""
    queries = sample[:FIT_QUERIES]
    d = distances(queries, sample)
    d[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return Tables(sample.shape[1], tables, 1, 1.0, seed), 1
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    width = 1.7 * float(np.median(np.take_along_axis(d, near[:, -1:], axis=1))) or 1.0
    hashes = max(6, round(np.log2(max(total, 64) / 64) / 1.6))
    while True:
        made, probes = Tables(sample.shape[1], tables, hashes, width, seed), 1
        while True:
            probes = min(probes, MOST_PROBES)
            if sample_recall(made, probes, sample, near) >= FIT_RECALL:
                return made, probes
            if probes == MOST_PROBES:
                break
            probes *= 2
        if 2 * tables <= MOST_TABLES:
            tables *= 2
        elif hashes > 1:
            hashes -= 1
        else:  # wider cells, until one holds everything
            width *= 2


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _keys_udf(tables: Tables, probes: int | None):
    """Per vector an array of (table, bucket): its own, or those to visit."""
    kind = pa.struct([("table", pa.int32()), ("bucket", pa.int64())])

    def udf(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(kind))
        x = _matrix(vectors)
        table, bucket, counts = [], [], np.zeros(len(x), np.int64)
        rows = [[] for _ in range(len(x))]
        for t in range(tables.n):
            cell, inside = tables.cells(x, t)
            own = tables.key(cell)
            for i in range(len(x)):
                rows[i].append((t, own[i : i + 1] if probes is None else tables.visit(cell[i], inside[i], probes)))
        for i, parts in enumerate(rows):
            for t, keys in parts:
                table.append(np.full(len(keys), t, np.int32))
                bucket.append(keys)
                counts[i] += len(keys)
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(table)), pa.array(np.concatenate(bucket))],
                                            fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)

    return F.arrow_udf(udf, "array<struct<table:int,bucket:long>>")


def _best(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, most: int) -> pa.RecordBatch:
    """Each query's ``most`` nearest of the given vectors, ties to the smaller id."""
    best = Nearest(qid, q, most)
    rows = np.arange(len(qid))
    step = max(1, DISTANCES // max(1, len(qid)))
    for at in range(0, len(vid), step):
        best.add(rows, vid[at : at + step], x[at : at + step])
    return best.result()


class Nearest:
    """The ``most`` nearest entries of each query among those added so far.

    A matrix product gives squared distances up to rounding; pairs above the query's
    ``most``-th distance, by more than rounding can explain, are passed over. The others
    get their distance by differences, so results do not depend on the product."""

    def __init__(self, qid: np.ndarray, q: np.ndarray, most: int):
        self.qid, self.q, self.most = qid, q, most
        # the product of (q, limit, 1) and (x, 1, norm) is below 0 where x is too far
        self.norm = (q * q).sum(axis=1)
        self.left = np.concatenate([q, np.full((len(q), 1), np.inf), np.ones((len(q), 1))], axis=1)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, rows: np.ndarray, vid: np.ndarray, x: np.ndarray) -> None:
        """Compares the queries at ``rows`` with entries."""
        step = max(1, DISTANCES // max(1, len(x)))
        right = np.concatenate([x, np.ones((len(x), 1)), (-0.5 + SLACK) * (x * x).sum(axis=1, keepdims=True)], axis=1).T
        for at in range(0, len(rows) if len(x) else 0, step):
            some = rows[at : at + step]
            r, c = np.nonzero(~(self.left[some] @ right < 0))  # NaN (squares that overflow) is never passed over
            for lo in range(0, len(r), DISTANCES // 16):
                i, j = some[r[lo : lo + DISTANCES // 16]], c[lo : lo + DISTANCES // 16]
                d = np.sqrt(((self.q[i] - x[j]) ** 2).sum(axis=1))
                self.held.append((i, vid[j], d))
                self.waiting += len(d)
                if self.waiting > max(1 << 16, 8 * self.most * len(self.q)):
                    self._settle()

    def _settle(self) -> None:
        """Keeps the ``most`` best of each query, an entry once."""
        if not self.held:
            return
        row, vid, d = (np.concatenate(h) for h in zip(*self.held))
        order = np.lexsort((vid, d, row))
        row, vid, d = row[order], vid[order], d[order]
        once = np.r_[True, (row[1:] != row[:-1]) | (vid[1:] != vid[:-1]) | (d[1:] != d[:-1])]
        row, vid, d = row[once], vid[once], d[once]
        first = np.searchsorted(row, row)
        rank = np.arange(len(row)) - first
        last = rank == self.most - 1
        self.left[row[last], -2] = 0.5 * d[last] ** 2 - (0.5 - SLACK) * self.norm[row[last]]
        keep = rank < self.most
        self.held, self.waiting = [(row[keep], vid[keep], d[keep])], 0

    def result(self) -> pa.RecordBatch:
        self._settle()
        row, vid, d = self.held[0] if self.held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.RecordBatch.from_arrays([pa.array(self.qid[row]), pa.array(vid), pa.array(d)], ["qid", "vid", "score"])


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last + 1 of each run of equal rows."""
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    return zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(keys)].tolist())


def _search_parts(most: int):
    """Sorted rows (part, entry, table, bucket, chunk, id, vec, visits): a part's queries
    come first, each once with the (table, bucket, chunk) it visits there; then its
    entries by bucket chunk. A task holds the queries of one part and one batch of entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, asked, best, starts, whom = None, [], None, {}, None

        def ready():
            nonlocal best, starts, whom, asked
            qid, q = np.concatenate([a[0] for a in asked]), np.concatenate([a[1] for a in asked])
            rows = np.repeat(np.arange(len(qid)), np.concatenate([a[2] for a in asked]))
            keys = np.concatenate([a[3] for a in asked])
            order = np.lexsort((rows, *keys.T[::-1]))
            keys, whom = keys[order], rows[order]
            starts = {tuple(keys[a].tolist()): (a, b) for a, b in _runs(keys)} if len(keys) else {}
            best, asked = Nearest(qid, q, most), []

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            entry = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in _runs(np.stack([parts, entry], axis=1)):
                if parts[a] != part:
                    if best is not None:
                        yield best.result()
                    part, asked, best = parts[a], [], None
                ids, x = batch.column(5).slice(a, b - a).to_numpy(zero_copy_only=False), _matrix(batch.column(6).slice(a, b - a))
                if not entry[a]:
                    visits = batch.column(7).slice(a, b - a)
                    flat = visits.flatten()
                    asked.append((ids, x, visits.value_lengths().to_numpy(zero_copy_only=False), np.stack(
                        [f.to_numpy(zero_copy_only=False).astype(np.int64) for f in flat.flatten()], axis=1)))
                    continue
                if asked:
                    ready()
                if best is None:  # nobody visits this part
                    continue
                keys = np.stack([batch.column(i).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4)], axis=1)
                for lo, hi in _runs(keys):
                    at = starts.get(tuple(keys[lo].tolist()))
                    if at:
                        best.add(whom[at[0] : at[1]], ids[lo:hi], x[lo:hi])
        if best is not None:
            yield best.result()

    return run


def _valid(vectors: Column) -> Column:
    finite = F.forall(vectors, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.isNotNull() & finite & F.exists(vectors, lambda v: v != 0)


def _merge(found: DataFrame, most: int) -> DataFrame:
    """Best ``most`` entries of each query, each entry once."""
    once = found.groupBy("qid", "vid").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("score", "vid"))
    return once.withColumn("r", rank).filter(F.col("r") <= most).drop("r")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = 4, seed: int = 7) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest found
    of each row for which ``is_query`` (over the id column) holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          is_query.alias("asks"))
    rows = cut_lineage(rows.filter(F.col("id").isNotNull() & _valid(F.col("vec"))), "vectors")
    widths = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not widths:
        return empty
    rows = rows.filter(F.size("vec") == widths[0]["dim"])
    most = k + 1
    same = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    entries = cut_lineage(rows.select("id", "vec").withColumn("r", same).filter(F.col("r") <= most).groupBy("vec").agg(
        F.min("id").alias("vid"), F.sort_array(F.collect_set("id")).alias("ids")), "entries")
    asks = rows.filter("asks").select("id", "vec").distinct()
    asking = cut_lineage(asks.join(entries.select("vec", "vid"), "vec").select(
        F.col("id").alias("query_id"), F.col("vid").alias("qid"), "vec"), "queries")
    queries = asking.select("qid", "vec").dropDuplicates(["qid"])

    total = entries.count()
    sample = np.array([r["vec"] for r in entries.orderBy(F.xxhash64("vid"), "vid").limit(FIT_ROWS).select("vec").collect()])
    made, probes = fit(sample, total, k, tables, seed)
    index = cut_lineage(entries.select("vid", "vec", F.explode(_keys_udf(made, None)("vec")).alias("k"))
                        .select("k.table", "k.bucket", F.col("vid").alias("id"), "vec"), "index")
    chunks = index.groupBy("table", "bucket").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    big = chunks.filter("chunks > 1")
    mine = F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1)))
    held = index.join(big, ["table", "bucket"], "left").select("table", "bucket", mine.cast("int").alias("chunk"), "id", "vec")
    # a bucket chunk lies in one part; a query goes to each part once, with all it visits there
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("table", "bucket", "chunk"), F.lit(parts)).cast("int").alias("part")
    visits = queries.select(F.col("qid").alias("id"), F.explode(_keys_udf(made, probes)("vec")).alias("k")).select(
        "k.table", "k.bucket", "id")
    sent = visits.join(big, ["table", "bucket"], "left").select(
        "table", "bucket", "id", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("chunk"))
    lists = sent.groupBy(part, "id").agg(F.collect_list(F.struct("table", "bucket", "chunk")).alias("visits"))
    asked = lists.join(queries.select(F.col("qid").alias("id"), "vec"), "id")
    key = ["table", "bucket", "chunk"]
    none = F.lit(None)
    met = held.select(part, F.lit(True).alias("entry"), *key, "id", "vec", none.cast(lists.schema["visits"].dataType).alias("visits")).unionByName(
        asked.select("part", F.lit(False).alias("entry"), none.cast("int").alias("table"), none.cast("long").alias("bucket"),
                     none.cast("int").alias("chunk"), "id", "vec", "visits"))
    met = met.repartition(parts, "part").sortWithinPartitions("part", "entry", *key)
    found = cut_lineage(_merge(met.mapInArrow(_search_parts(most), "qid long, vid long, score double"), most), "found")

    got = found.join(entries.select("vid", F.size("ids").alias("n")), "vid").groupBy("qid").agg(F.sum("n").alias("n"))
    short = cut_lineage(queries.join(got, "qid", "left").filter(F.coalesce("n", F.lit(0)) <= k)
                        .select("qid", "vec"), "short")
    last = None
    while True:  # blocks of queries against all vectors; none or few, unless the table is tiny
        block = (short if last is None else short.filter(F.col("qid") > last)).orderBy("qid").limit(FALLBACK).collect()
        if not block:
            break
        last = block[-1]["qid"]
        qid, q = np.array([r["qid"] for r in block], np.int64), np.array([r["vec"] for r in block])

        def scan(batches, qid=qid, q=q):
            for b in batches:
                if b.num_rows:
                    yield _best(qid, q, b.column(0).to_numpy(), _matrix(b.column(1)), most)

        scanned = entries.select("vid", "vec").mapInArrow(scan, "qid long, vid long, score double")
        found = cut_lineage(_merge(found.unionByName(scanned), most), "found")  # a short plan, however many blocks
    expanded = (asking.select("query_id", "qid").join(found, "qid").join(entries.select("vid", "ids"), "vid")
                .select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return expanded.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Weighted sampling with replacement for any row weights.

``weighted_draws`` gives each group a number of draws; a draw takes a row with the
probability of its weight in the group. The draws are split down a tree of weight
sums: a multinomial splits a group's draws over super-buckets, then a super-bucket's
over its buckets, each from one short list of sums; inside a bucket a Walker alias table
answers a draw in constant time. A bucket with many draws -- one row may hold half of
all weight -- is dealt into chunks of draws, so no task makes more than ``chunk_draws``
of them at once. Rows never meet the draws in a join on a class or an index.

Every random step is a generator seeded by (seed, group, bucket, chunk), and weight
sums add up in a fixed order, so the result is the same on any partitioning. Draw
numbers (0 to n - 1) are given out by a keyed permutation, so that the draws of one
bucket are spread over all numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from labelkiln.session import cut_lineage

#: Buckets of a super-bucket.
FAN = 1024


def generator(seed: int, *names) -> np.random.Generator:
    """A generator of its own for each combination of names."""
    return np.random.default_rng([seed, *(zlib.crc32(str(n).encode()) for n in names)])


def alias_table(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Walker's table: column i keeps itself with probability ``keep[i]``, and gives
    ``other[i]`` else."""
    n = len(weights)
    keep, other = weights * (n / weights.sum()), np.arange(n)
    low, high = list(np.flatnonzero(keep < 1)), list(np.flatnonzero(keep >= 1))
    while low and high:
        a, b = low.pop(), high[-1]
        other[a] = b
        keep[b] -= 1 - keep[a]
        if keep[b] < 1:
            low.append(high.pop())
    keep[low + high] = 1.0  # rounding leftovers
    return keep, other


def alias_draws(weights: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` positions drawn by weight."""
    keep, other = alias_table(weights)
    at = rng.integers(0, len(weights), n)
    return np.where(rng.random(n) < keep[at], at, other[at])


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 to n - 1: four Feistel rounds, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        v = out[todo]
        left, right = v >> np.uint64(half), v & mask
        for r in range(4):
            h = (right + np.uint64(key & 0xFFFFFFFF) + np.uint64(r << 32)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _multinomial(seed: int):
    """(draws, weight sums, name) -> draws of each part and how many come before it."""
    kind = pa.struct([("n", pa.int64()), ("before", pa.int64())])

    def split(n: pa.Array, weights: pa.Array, name: pa.Array) -> pa.Array:
        out = []
        for draws, w, key in zip(n.to_pylist(), weights, name.to_pylist()):
            w = w.values.to_numpy(zero_copy_only=False)
            got = generator(seed, key).multinomial(draws, w / w.sum())
            out.append([{"n": int(a), "before": int(b)} for a, b in zip(got, np.cumsum(got) - got)])
        return pa.array(out, pa.list_(kind))

    return F.arrow_udf(split, "array<struct<n:long,before:long>>")


def _split(parents: DataFrame, parts: DataFrame, on: list[str], part: str, seed: int) -> DataFrame:
    """``parents(on, n, before, total)`` over ``parts(on, part, weight)``: a row of
    ``on, part, n, before, total`` for each part with draws. A parent's parts are one
    list, bounded by ``FAN`` or by the number of super-buckets."""
    lists = parts.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(part, "weight"))).alias("parts"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]
    joined = parents.alias("a").join(lists.alias("b"), _all(same))
    split = joined.select(*[F.col(f"a.{c}") for c in on], "total", F.col("before").alias("base"), "parts", _multinomial(seed)(
        F.col("n"), F.transform("parts", lambda p: p["weight"]), F.concat_ws("/", F.lit(part), *[
            F.coalesce(F.col(f"a.{c}").cast("string"), F.lit("\0")) for c in on])).alias("drawn"))
    each = split.select(*on, "total", "base", F.explode(F.arrays_zip("parts", "drawn")).alias("z"))
    return each.select(*on, F.col(f"z.parts.{part}").alias(part), F.col("z.drawn.n").alias("n"),
                       (F.col("base") + F.col("z.drawn.before")).alias("before"), "total").filter("n > 0")


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out &= c
    return out


def weighted_draws(rows: DataFrame, id_col: str, weight_col: str, group_cols: Sequence[str], draws: DataFrame, seed: int = 42,
                   bucket_rows: int = 1024, chunk_draws: int = 1 << 16) -> DataFrame:
    """``group_cols, draw, id_col``: for each row of ``draws(group_cols, n)``, ``n`` rows
    of its group drawn with replacement by weight.

    Weights are any non-negative numbers; a null weight is 0, a negative or non-finite
    one an error. Rows with equal group, id and weight count together. A group without
    positive weight gives no draws; so does one that ``draws`` does not name."""
    g = list(group_cols)
    w = F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0))
    checked = F.when((w >= 0) & (w < float("inf")), w).otherwise(
        F.raise_error(F.concat(F.lit("weight "), w.cast("string"))).cast("double"))
    units = (rows.select(*g, F.col(id_col).alias("_id"), checked.alias("_w")).filter("_w > 0")
             .groupBy(*g, "_id", "_w").agg(F.count("*").alias("_m")).withColumn("_w", F.col("_w") * F.col("_m")))
    units = cut_lineage(units, "units")
    buckets = max(1, -(-units.count() // bucket_rows))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *g, "_id", "_w"), F.lit(buckets))
    # a bucket's rows are one list of about bucket_rows (id, weight) pairs
    tables = units.withColumn("bucket", bucket).groupBy(*g, "bucket").agg(
        F.array_sort(F.collect_list(F.struct("_id", "_w"))).alias("rows"))
    tables = cut_lineage(tables.withColumn("super", F.floor(F.col("bucket") / FAN)).withColumn(
        "weight", F.aggregate("rows", F.lit(0.0), lambda a, r: a + r["_w"])), "buckets")
    supers = tables.groupBy(*g, "super").agg(F.array_sort(F.collect_list(F.struct("bucket", "weight"))).alias("b")).withColumn(
        "weight", F.aggregate("b", F.lit(0.0), lambda a, r: a + r["weight"])).drop("b")
    zero = F.lit(0).cast("long")
    groups = draws.select(*g, F.col("n").cast("long").alias("n"), zero.alias("before"), F.col("n").cast("long").alias("total"))
    top = _split(groups.filter("n > 0"), supers, g, "super", seed)
    drawn = _split(top, tables.select(*g, "super", "bucket", "weight"), [*g, "super"], "bucket", seed)
    chunks = drawn.withColumn("chunk", F.explode(F.sequence(zero, F.floor((F.col("n") - 1) / chunk_draws))))
    same = _all([F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in g] + [F.col("a.bucket") == F.col("b.bucket")])
    dealt = chunks.alias("a").join(tables.alias("b"), same).select(
        *[F.col(f"a.{c}") for c in g], "a.bucket", "chunk", "total",
        (F.col("before") + F.col("chunk") * chunk_draws).alias("from"),
        F.least(F.lit(chunk_draws).cast("long"), F.col("n") - F.col("chunk") * chunk_draws).alias("n"),
        F.transform("rows", lambda r: r["_id"]).alias("ids"), F.transform("rows", lambda r: r["_w"]).alias("weights"))
    k = len(g)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                group = [one.column(j) for j in range(k)]
                bucket_, chunk, total, first, n = (one.column(k + j)[0].as_py() for j in range(5))
                names = [x[0].as_py() for x in group]
                weights = one.column(k + 6)[0].values.to_numpy(zero_copy_only=False)
                at = alias_draws(weights, n, generator(seed, *names, "bucket", bucket_, chunk))
                number = permuted(np.arange(first, first + n), total, zlib.crc32(repr((seed, names)).encode()))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.repeat(x[0], n) for x in group), pa.array(number), one.column(k + 5)[0].values.take(pa.array(at))],
                    [*g, "draw", id_col])

    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([*(T.StructField(c, kinds[c]) for c in g), T.StructField("draw", T.LongType()),
                           T.StructField(id_col, kinds[id_col])])
    # a given number of partitions: small as the chunks are, their draws are many, so they stay apart
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, *g, "bucket", "chunk").mapInArrow(draw, schema)

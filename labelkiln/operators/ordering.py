"""Total orders without a single-task window.

Two building blocks replace ``Window.orderBy(...)`` without ``partitionBy``
(which funnels every row through one task):

* ``with_file_row_index`` -- the 0-based line number of each row in file order
  (``enumerate`` over a file). Each file block is read by one task in order, so
  ``monotonically_increasing_id`` is contiguous inside a block; a block table
  (one row per block) gives each block's offset.
* ``prefix_below`` -- for rows keyed by ``(group, value)``, the sum of weight
  columns over all rows of the group with a strictly smaller value. Rows are
  partitioned by sampled ranges; running sums inside each range and one total per
  (group, range) finish the job. No window ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from labelkiln.session import cut_lineage


def _before(group_cols, *order) -> Window:
    """Rows of the same group strictly before the current one."""
    w = Window.partitionBy(*group_cols).orderBy(*order) if group_cols else Window.orderBy(*order)
    return w.rowsBetween(Window.unboundedPreceding, -1)


def default_buckets(df: DataFrame) -> int:
    """Bucket count scaled to the cluster: 64 per configured shuffle partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(64, 64 * n)


def with_file_row_index(df: DataFrame, col: str = "row_idx", max_broadcast_blocks: int = 2_000_000) -> DataFrame:
    """Add the 0-based row position in file order (files by path, then by byte
    offset). ``df`` must be a file scan with no filter, shuffle or repartition
    before this call (row-preserving projections are fine)."""
    base_cols = df.columns
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_lk_file"),
        F.col("_metadata.file_block_start").alias("_lk_block"),
        F.monotonically_increasing_id().alias("_lk_mid"),
    )
    blocks = tagged.groupBy("_lk_file", "_lk_block").agg(
        F.min("_lk_mid").alias("_lk_first"), F.count(F.lit(1)).alias("_lk_n"))
    # one row per file block: bounded by input bytes / split size
    w = _before([], "_lk_file", "_lk_block")
    offsets = blocks.select("_lk_file", "_lk_block", "_lk_first",
                            F.coalesce(F.sum("_lk_n").over(w), F.lit(0)).alias("_lk_off"))
    # one row per file block: at most (#files + #scan splits) rows, read from
    # the scan's own file listing; within the bound it is broadcast instead of
    # shuffling every row to it
    bound = len(df.inputFiles()) + df.rdd.getNumPartitions()
    if bound <= max_broadcast_blocks:
        offsets = F.broadcast(offsets)
    return (tagged.join(offsets, ["_lk_file", "_lk_block"])
            .select(*[F.col(c) for c in base_cols],
                    (F.col("_lk_off") + F.col("_lk_mid") - F.col("_lk_first")).cast("bigint").alias(col)))


COARSE_BUCKETS = 256


def value_buckets(df: DataFrame, group_cols: Sequence[str], value_col: str, buckets: int | None = None,
                  lo: float | None = None, hi: float | None = None, coarse: int = COARSE_BUCKETS) -> DataFrame:
    """Adds ``_lk_b``: a bucket id that is monotone in ``value_col`` within each
    group, with about the same number of rows per bucket whatever the value
    distribution. Coarse cuts are approximate quantiles of the group's values
    (a mergeable sketch, one small row per group); inside each coarse slice the
    value range is cut into equal-width sub-buckets. Scores piled into a tiny
    range (e.g. many probabilities just below 1.0) therefore still spread over
    many buckets. With ``lo``/``hi`` and ``coarse=1`` it is plain fixed-width."""
    g = list(group_cols)
    nb = buckets or default_buckets(df)
    c = max(1, min(coarse, nb))
    fine = max(1, nb // c)
    v = F.col(value_col).cast("double")
    if c == 1 and lo is not None and hi is not None:
        lo_c, hi_c, b1 = F.lit(float(lo)), F.lit(float(hi)), F.lit(0)
        ranged = df
    elif c == 1:  # one coarse slice: the group's own range
        stats = df.groupBy(*g).agg(F.min(v).alias("_lk_min"), F.max(v).alias("_lk_max"))
        ranged = df.join(stats, g)
        lo_c, hi_c, b1 = F.col("_lk_min"), F.col("_lk_max"), F.lit(0)
    else:
        probs = [k / c for k in range(1, c)]
        stats = df.groupBy(*g).agg(F.percentile_approx(v, probs, max(10_000, 10 * c)).alias("_lk_q"),
                                   F.min(v).alias("_lk_min"), F.max(v).alias("_lk_max"))
        ranged = df.join(stats, g)
        q = F.col("_lk_q")
        b1 = F.size(F.filter(q, lambda x: x <= v))          # 0 .. c-1, monotone in v
        lo_c = F.when(b1 == 0, F.col("_lk_min")).otherwise(F.element_at(q, b1))
        hi_c = F.when(b1 >= c - 1, F.col("_lk_max")).otherwise(F.element_at(q, b1 + 1))
    span = hi_c - lo_c
    b2 = F.when(span > 0, F.least(F.lit(fine - 1), F.greatest(
        F.lit(0), F.floor((v - lo_c) / span * fine)))).otherwise(F.lit(0))
    out = ranged.withColumn("_lk_b", F.coalesce((b1 * F.lit(fine) + b2).cast("int"), F.lit(0)))
    return out.drop("_lk_q", "_lk_min", "_lk_max")


def _running_sums(groups: int, weights: Sequence[int]):
    """Rows sorted by group and value -> the same with the range's number and, per weight
    column, the sum over the earlier rows of the group in this range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carry = None, [0] * len(weights)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for j in range(groups):
                codes = b.column(j).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            new[0] = last != (first := tuple(b.column(j)[0].as_py() for j in range(groups)))
            starts = np.flatnonzero(new)
            at = np.searchsorted(starts, np.arange(n), "right") - 1  # -1: the group of the batch before goes on
            sums = []
            for k, w in enumerate(weights):
                v = b.column(w).to_numpy(zero_copy_only=False)
                before = np.cumsum(v) - v
                own = before - np.where(at >= 0, before[starts[np.maximum(at, 0)]] if len(starts) else 0, 0)
                own = np.where(at >= 0, own, own + carry[k])
                carry[k] = own[-1] + v[-1]
                sums.append(pa.array(own))
            last = first if not new[1:].any() else tuple(b.column(j)[n - 1].as_py() for j in range(groups))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int64)), *sums],
                                             [*b.schema.names, "_lk_b", *(f"_lk_l_{k}" for k in range(len(weights)))])

    return run


def prefix_below(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 weight_cols: Sequence[str], buckets: int | None = None,
                 lo: float | None = None, hi: float | None = None,
                 suffix: str = "_below") -> DataFrame:
    """For each row add ``<w><suffix>`` = sum of ``w`` over rows of the same group
    whose ``value_col`` is strictly smaller. Rows with equal values must already
    be collapsed to one row (group by value first): then "strictly smaller" is
    "earlier in order".

    Rows are partitioned by sampled ranges of (group, value), so each partition holds
    about as many rows whatever the distribution, and equal values never part. Sums run
    inside a partition; one total per (group, partition) gives what lies before it.
    ``buckets`` is the number of ranges; ``lo`` and ``hi`` are not needed any more."""
    cols = df.columns
    g = list(group_cols)
    if not g:  # a constant group keeps every join an equi-join
        df, g = df.withColumn("_lk_all", F.lit(0)), ["_lk_all"]
    rest = [c for c in df.columns if c not in (*g, value_col)]
    df = df.select(*g, value_col, *rest)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = [T.LongType() if isinstance(df.schema[c].dataType, T.IntegralType) else T.DoubleType() for c in weight_cols]
    schema = T.StructType([*df.schema.fields, T.StructField("_lk_b", T.LongType()),
                           *(T.StructField(f"_lk_l_{k}", t) for k, t in enumerate(kinds))])
    ranged = df.repartitionByRange(n, *g, value_col).sortWithinPartitions(*g, value_col)
    # read twice below, and the ranges are sampled: written once
    local = cut_lineage(ranged.mapInArrow(_running_sums(len(g), [df.columns.index(c) for c in weight_cols]), schema), "ranges")

    # one row per (group, range)
    totals = local.groupBy(*g, "_lk_b").agg(*[F.sum(c).alias(f"_lk_t_{c}") for c in weight_cols])
    wb = _before(g, "_lk_b")
    offs = totals.select(*g, "_lk_b", *[F.coalesce(F.sum(f"_lk_t_{c}").over(wb), F.lit(0)).alias(f"_lk_o_{c}")
                                        for c in weight_cols])
    out = local.join(offs, [*g, "_lk_b"])
    return out.select(*cols, *[(F.col(f"_lk_o_{c}") + F.col(f"_lk_l_{k}")).alias(f"{c}{suffix}")
                               for k, c in enumerate(weight_cols)])


def average_rank(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 rank_col: str = "rank", buckets: int | None = None) -> DataFrame:
    """1-based average rank of ``value_col`` inside each group (ties share the
    mean of their positions). Returns one row per distinct (group, value):
    ``group_cols, value_col, rank_col``."""
    g = list(group_cols)
    ties = df.groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_lk_cnt"))
    ranked = prefix_below(ties, g, value_col, ["_lk_cnt"], buckets=buckets)
    return ranked.select(*g, value_col, (F.col("_lk_cnt_below") + (F.col("_lk_cnt") + F.lit(1)) / F.lit(2.0))
                         .alias(rank_col))


def rank_by_key(df: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str],
                col: str = "row_idx", buckets: int | None = None, limit: Column | int | None = None) -> DataFrame:
    """0-based position of each row inside its group when ordered by ``key_cols``
    (the first key must be a uniform bigint hash, e.g. ``hash52``; later keys
    break ties). Distributed: no window sees more than one bucket.

    With ``limit`` (an int or a Column of the group, e.g. a per-split limit) only
    rows with position < limit are returned, and only the buckets that can hold
    them are ranked, so "first n after a shuffle" never merges per-task top-n
    lists in one task."""
    g = list(group_cols)
    k0 = key_cols[0]
    nb = buckets or default_buckets(df)
    # 52-bit hash keys are uniform on [0, 2^52): fixed-width buckets are balanced
    b = df.withColumn("_lk_b", F.coalesce(
        F.floor(F.col(k0).cast("double") / F.lit(float(2 ** 52)) * nb).cast("int"), F.lit(0)))
    totals = b.groupBy(*g, "_lk_b").agg(F.count(F.lit(1)).alias("_lk_t"))
    offs = totals.select(*g, "_lk_b", F.coalesce(F.sum("_lk_t").over(_before(g, "_lk_b")), F.lit(0)).alias("_lk_o"))
    if limit is not None:
        # the limit may only use group columns; buckets starting past it cannot
        # hold a kept row, so they are dropped before any row-level work
        lim = F.lit(limit) if isinstance(limit, int) else limit
        offs = offs.withColumn("_lk_lim", lim).filter(F.col("_lk_o") < F.col("_lk_lim"))
    wi = Window.partitionBy(*g, "_lk_b").orderBy(*key_cols)  # one bucket per window
    ranked = b.join(offs, [*g, "_lk_b"]).withColumn("_lk_l", F.row_number().over(wi) - 1)
    pos = (F.col("_lk_o") + F.col("_lk_l")).cast("bigint")
    if limit is not None:
        ranked = ranked.filter(pos < F.col("_lk_lim"))
    return ranked.select(*df.columns, pos.alias(col))


def order_key(seed: int | str, *id_cols: str) -> Column:
    """Seeded shuffle key: reproducible on any partitioning (unlike rand())."""
    from labelkiln.functions.columns import hash52
    parts: list = [str(seed), ":"]
    for i, c in enumerate(id_cols):
        if i:
            parts.append(":")
        parts.append(F.col(c))
    return hash52(*parts)

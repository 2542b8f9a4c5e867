"""Shuffle, limit, class weights, weighted resampling and batching.

Randomness is a seeded md5 of the row key, so every draw is reproducible on
any partitioning (``rand()`` depends on partition layout).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from labelkiln.functions.columns import hash52
from labelkiln.operators.ordering import order_key, rank_by_key
from labelkiln.session import cut_lineage


def shuffle_limit(df: DataFrame, id_col: str, seed: int = 42, split_col: str | None = "split",
                  limits: Mapping[str, int] | None = None, index_col: str = "row_idx") -> DataFrame:
    """Seeded full shuffle, re-indexed from 0 per split, keeping the first
    ``limits[split]`` rows (all rows of splits without a limit).

    Only (id, split, key) take part in the ranking; wide columns (text) are
    joined back afterwards. The kept-id table is small when every split is
    limited; AQE then broadcasts it from its measured size (no hint here,
    because a split without a limit keeps all of its rows)."""
    groups = [split_col] if split_col else []
    # narrow (id, split, key) table, read twice by the ranking: written once
    keys = cut_lineage(df.select(id_col, *groups).withColumn("_lk_key", order_key(seed, id_col)), "keys")
    lim = None
    if limits:
        lim = F.lit(2 ** 62)
        for s, n in limits.items():
            lim = F.when(F.col(split_col) == s, F.lit(int(n))).otherwise(lim)
    ranked = rank_by_key(keys, groups, ["_lk_key", id_col], index_col, limit=lim).drop("_lk_key")
    return df.join(ranked, [id_col, *groups])


def batches(df: DataFrame, index_col: str = "row_idx", batch_size: int = 10, name: str = "batch_id") -> DataFrame:
    """Fixed-size batches over a 0-based order; the last batch may be short."""
    return df.withColumn(name, F.floor(F.col(index_col) / F.lit(batch_size)).cast("bigint"))


def class_counts(long_df: DataFrame, label_col: str = "label_name", y: str = "y") -> DataFrame:
    return long_df.groupBy(label_col, y).agg(F.count(F.lit(1)).alias("n"))


def class_weights(counts: DataFrame) -> DataFrame:
    """Inverse class frequency; an empty class has no row and needs no weight."""
    return counts.withColumn("weight", F.lit(1.0) / F.col("n"))


def row_weights(long_df: DataFrame, weights: DataFrame, label_col: str = "label_name", y: str = "y") -> DataFrame:
    """Each row gets its class weight. The weight table has one row per (label,
    class) of the data; it is broadcast by a hint, because the planner would measure its
    size only after shuffling the rows."""
    return long_df.join(F.broadcast(weights.select(label_col, y, "weight")), [label_col, y])


def weighted_resample(long_df: DataFrame, id_col: str = "doc_id", draw_col: str = "row_idx",
                      seed: int = 42, label_col: str = "label_name", y: str = "y") -> DataFrame:
    """Class-balanced sampling with replacement, N draws per label (N = rows).

    With weights 1/n_class every class has total weight 1, so a draw is: pick a
    class with probability 1/2 (the only class if the other is empty), then a
    row of it uniformly. Both choices are md5 hashes of the draw number, and the
    row is found by an equi-join on (label, class, index within class) -- no
    cumulative weights, no range join. ``draw_col`` numbers the draws 0..N-1
    (the row's own position in the shuffled order)."""
    # the rows are read three times below (counts, class index, draws)
    long_df = cut_lineage(long_df.select(label_col, y, id_col, draw_col))
    counts = long_df.groupBy(label_col).agg(F.count_if(F.col(y) == 0).alias("_n0"),
                                            F.count_if(F.col(y) == 1).alias("_n1"))
    keyed = long_df.select(label_col, y, id_col).withColumn("_lk_key", order_key(seed, id_col))
    indexed = rank_by_key(keyed, [label_col, y], ["_lk_key", id_col], "_idx").drop("_lk_key")
    draws = long_df.select(label_col, F.col(draw_col).cast("bigint").alias("draw")).join(counts, label_col)
    coin = hash52("draw:", F.col(label_col), ":", F.col("draw"), ":class") % 2
    cls = F.when(F.col("_n0") == 0, 1).when(F.col("_n1") == 0, 0).otherwise(coin).cast("int")
    draws = draws.withColumn(y, cls)
    n_cls = F.when(F.col(y) == 1, F.col("_n1")).otherwise(F.col("_n0"))
    draws = draws.withColumn("_idx", hash52("draw:", F.col(label_col), ":", F.col("draw"), ":idx") % n_cls)
    return draws.select(label_col, y, "_idx", "draw").join(indexed, [label_col, y, "_idx"]) \
        .select(label_col, "draw", id_col, y)


def label_vectors(df: DataFrame, label_cols: Sequence[str], name: str = "labels") -> DataFrame:
    """The label columns as one float vector in a fixed order."""
    return df.withColumn(name, F.array(*[F.col(c) for c in label_cols]).cast("array<float>"))

"""Model / threshold selection over metric histories.

Histories are long tables ``(<group...>, epoch, metric, value)``: a group holds
one row per epoch, so every window here is bounded by the epoch count, never by
the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from labelkiln.operators.metrics import f1_expr


def running_best(history: DataFrame, group_cols: Sequence[str], order_col: str = "epoch",
                 value_col: str = "value") -> DataFrame:
    """Adds ``saved``: true on the first row, later only when the value is
    strictly greater than every earlier one (the keep-best-model rule)."""
    w = Window.partitionBy(*group_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.max(value_col).over(w)
    return history.withColumn("saved", prev.isNull() | (F.col(value_col) > prev))


def first_argmax(history: DataFrame, group_cols: Sequence[str], order_col: str = "epoch",
                 value_col: str = "value", best_col: str | None = None) -> DataFrame:
    """The first ``order_col`` holding the maximum of ``value_col`` per group
    (= the last saved row of ``running_best``). ``max_by`` on a struct with the
    negated order breaks ties towards the earliest row."""
    best_col = best_col or f"best_{order_col}"
    key = F.struct(F.col(value_col), -F.col(order_col))
    return history.groupBy(*group_cols).agg(
        F.max_by(F.col(order_col), key).alias(best_col), F.max(value_col).alias(f"best_{value_col}"))


def threshold_sweep(scored: DataFrame, group_cols: Sequence[str], thresholds: Sequence[float],
                    y: str = "y", p: str = "p") -> DataFrame:
    """Confusion counts and F1 for every threshold of a sorted grid, without
    multiplying the rows by the grid size.

    Each score goes to bin = number of thresholds <= score (inclusive literal
    comparisons, so boundary scores land exactly where ``p >= t`` puts them);
    pos/neg counts per (group, bin) are tiny, and the prediction at threshold j
    is positive exactly for bins > j, so tp/fp are suffix sums over bins."""
    g = list(group_cols)
    ts = [float(t) for t in thresholds]
    if ts != sorted(ts):
        raise ValueError("thresholds must be sorted ascending")
    pc = F.col(p)
    bin_expr = sum((F.when(pc >= F.lit(t), 1).otherwise(0) for t in ts), F.lit(0))
    bins = scored.groupBy(*g, bin_expr.alias("_bin")).agg(
        F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) != 1).alias("_neg"))
    # one row per (group, bin, threshold index): |groups| x (K+1) x K, grid-bounded
    grid = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(len(ts) - 1)).alias("j"),
                                  F.array(*[F.lit(t) for t in ts]).alias("t")))
    per = bins.select(*g, "_bin", "_pos", "_neg", grid.alias("_g"))
    above = F.col("_bin") > F.col("_g.j")
    counts = per.groupBy(*g, F.col("_g.j").alias("_j"), F.col("_g.t").alias("threshold")).agg(
        F.sum(F.when(above, F.col("_pos")).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(above, F.col("_neg")).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(~above, F.col("_pos")).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when(~above, F.col("_neg")).otherwise(0)).cast("bigint").alias("tn"))
    return counts.select(*g, "threshold", "tp", "fp", "fn", "tn", f1_expr().alias("f1"))


def mean_over(df: DataFrame, group_cols: Sequence[str], value_col: str, name: str) -> DataFrame:
    return df.groupBy(*group_cols).agg(F.avg(value_col).alias(name))


def best_threshold(mean_f1: DataFrame, group_cols: Sequence[str], value_col: str = "mean_f1",
                   tie_digits: int = 12) -> DataFrame:
    """Arg-max threshold per group, first (smallest) threshold on ties. Means
    equal as fractions can differ in the last bit depending on summation
    order, so they are compared at ``tie_digits`` decimals."""
    key = F.struct(F.round(F.col(value_col), tie_digits), -F.col("threshold"))
    return mean_f1.groupBy(*group_cols).agg(F.max_by("threshold", key).alias("best_threshold"),
                                            F.max(value_col).alias(f"best_{value_col}"))


def tail(history: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], k: int) -> DataFrame:
    """The last ``k`` rows per group in ``order_cols`` order. ``row_number <= k``
    is planned as a window group limit, so each map task forwards at most k rows
    per group before the shuffle."""
    w = Window.partitionBy(*group_cols).orderBy(*[F.col(c).desc() for c in order_cols])
    return history.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def history_arrays(history: DataFrame, group_cols: Sequence[str], order_col: str = "epoch",
                   value_col: str = "value", name: str = "values") -> DataFrame:
    """One array per group, values in ``order_col`` order (bounded: one entry per epoch)."""
    s = F.sort_array(F.collect_list(F.struct(F.col(order_col), F.col(value_col))))
    return history.groupBy(*group_cols).agg(F.transform(s, lambda x: x[value_col]).alias(name))


def pivot_by(history: DataFrame, group_cols: Sequence[str], pivot_col: str, values: Sequence[str],
             value_col: str = "value") -> DataFrame:
    """Side-by-side comparison (e.g. one column per encoder). ``values`` is the
    known pivot domain, so Spark need not scan for it."""
    return history.groupBy(*group_cols).pivot(pivot_col, list(values)).agg(F.first(value_col))

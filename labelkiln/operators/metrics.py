"""Evaluation metrics as aggregations.

Every binary metric comes from one pass of confusion counts per group; AUC and
Spearman need ranks, which come from ``ordering.prefix_below`` after ties are
collapsed by value (so a hot score value is one row, not a hot partition).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from labelkiln.functions.columns import bce_term, ce_term_2class
from labelkiln.operators.ordering import prefix_below
from labelkiln.session import cut_lineage


def predict(p="p", threshold: float = 0.48) -> Column:
    """Inclusive threshold: 1 when p >= threshold."""
    pc = F.col(p) if isinstance(p, str) else p
    return (pc >= F.lit(float(threshold))).cast("int")


def confusion(df: DataFrame, group_cols: Sequence[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """tp, fp, fn, tn and n per group (positive class = 1)."""
    yc, pc = F.col(y), F.col(pred)
    return df.groupBy(*group_cols).agg(
        F.count_if((pc == 1) & (yc == 1)).alias("tp"),
        F.count_if((pc == 1) & (yc != 1)).alias("fp"),
        F.count_if((pc != 1) & (yc == 1)).alias("fn"),
        F.count_if((pc != 1) & (yc != 1)).alias("tn"),
        F.count(F.lit(1)).alias("n"),
    )


def accuracy_expr() -> Column:
    return (F.col("tp") + F.col("tn")) / F.col("n")


def f1_expr() -> Column:
    """Binary F1 of class 1; 0 when there is no positive and no prediction."""
    d = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return F.when(d > 0, (2 * F.col("tp")).cast("double") / d).otherwise(F.lit(0.0))


def mcc_expr() -> Column:
    """Matthews correlation in doubles (integer products overflow); 0 when undefined."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    den = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return F.when(den > 0, (tp * tn - fp * fn) / F.sqrt(den)).otherwise(F.lit(0.0))


def accuracy_f1(conf: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return conf.select(*group_cols, accuracy_expr().alias("acc"), f1_expr().alias("f1"))


def acc_and_f1(conf: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    acc, f1 = accuracy_expr(), f1_expr()
    return conf.select(*group_cols, acc.alias("acc"), f1.alias("f1"), ((acc + f1) / 2).alias("acc_and_f1"))


def roc_auc(df: DataFrame, group_cols: Sequence[str], y: str = "y", p: str = "p",
            buckets: int | None = None, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Exact ROC-AUC per group (ties count one half); null with one class only.

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s)/2) / (P * N).
    Scores may have any range; buckets adapt to their distribution."""
    g = list(group_cols)
    # one row per (group, distinct score), read by several branches below:
    # materialised once instead of rescanning the scored rows per branch
    ties = cut_lineage(df.groupBy(*g, p).agg(F.count_if(F.col(y) == 1).alias("pos"),
                                             F.count_if(F.col(y) != 1).alias("neg")))
    ranked = prefix_below(ties, g, p, ["neg"], buckets=buckets, lo=lo, hi=hi)
    agg = ranked.groupBy(*g).agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))).alias("_num"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return agg.select(*g, F.try_divide(F.col("_num"), F.col("_p").cast("double") * F.col("_n").cast("double"))
                      .alias("roc_auc"))


def pearson(df: DataFrame, group_cols: Sequence[str], a: str, b: str, name: str = "pearson") -> DataFrame:
    """Pearson correlation; null for constant input (``corr`` would raise)."""
    return df.groupBy(*group_cols).agg(_pearson_col(a, b).alias(name))


def _pearson_col(a: str, b: str) -> Column:
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def _weighted_corr(df: DataFrame, g: list[str], x: str, y: str, w: str, name: str) -> DataFrame:
    """Correlation of columns already centred near their group means, rows
    weighted by ``w``; null when either side is constant."""
    wc, xc, yc = F.col(w).cast("double"), F.col(x), F.col(y)
    m = df.groupBy(*g).agg(F.sum(wc).alias("_n"), F.sum(wc * xc).alias("_sx"), F.sum(wc * yc).alias("_sy"),
                           F.sum(wc * xc * xc).alias("_sxx"), F.sum(wc * yc * yc).alias("_syy"),
                           F.sum(wc * xc * yc).alias("_sxy"))
    n = F.col("_n")
    cov = F.col("_sxy") / n - (F.col("_sx") / n) * (F.col("_sy") / n)
    vx = F.col("_sxx") / n - (F.col("_sx") / n) ** 2
    vy = F.col("_syy") / n - (F.col("_sy") / n) ** 2
    return m.select(*g, F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy)).alias(name))


def value_pairs(df: DataFrame, group_cols: Sequence[str], a: str, b: str) -> DataFrame:
    """``group, a, b, _w``: repeated (a, b) pairs collapsed to one weighted row
    and materialised -- every correlation branch reads this, not the input."""
    return cut_lineage(df.groupBy(*group_cols, a, b).agg(F.count(F.lit(1)).alias("_w")))


def spearman(df: DataFrame, group_cols: Sequence[str], a: str, b: str, name: str = "spearmanr",
             buckets: int | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Spearman correlation: Pearson of average ranks (ties averaged). Ranks
    come from distributed prefix sums over value counts; they are centred at
    (n + 1) / 2, their exact mean, so the moments do not cancel at large n."""
    g = list(group_cols)
    pairs = pairs if pairs is not None else value_pairs(df, g, a, b)
    sizes = pairs.groupBy(*g).agg(((F.sum("_w") + 1) / F.lit(2.0)).alias("_mid"))

    def ranks(col, out):
        counts = pairs.groupBy(*g, col).agg(F.sum("_w").alias("_lk_cnt"))
        r = prefix_below(counts, g, col, ["_lk_cnt"], buckets=buckets)
        r = r.select(*g, col, (F.col("_lk_cnt_below") + (F.col("_lk_cnt") + F.lit(1)) / F.lit(2.0)).alias(out))
        return r.join(sizes, g).select(*g, col, (F.col(out) - F.col("_mid")).alias(out))

    # a hot value joins once per distinct partner value, not once per row
    j = pairs.join(ranks(a, "_ra"), [*g, a]).join(ranks(b, "_rb"), [*g, b])
    return _weighted_corr(j, g, "_ra", "_rb", "_w", name)


def pearson_and_spearman(df: DataFrame, group_cols: Sequence[str], pred: str = "pred",
                         label: str = "label", buckets: int | None = None) -> DataFrame:
    """Pearson, Spearman and their mean from one materialised pair table."""
    g = list(group_cols)
    keep = list(g)
    if not g:  # a constant group keeps every join an equi-join
        df, g = df.withColumn("_lk_all", F.lit(0)), ["_lk_all"]
    pairs = value_pairs(df, g, pred, label)
    means = pairs.groupBy(*g).agg((F.sum(F.col("_w") * F.col(pred)) / F.sum("_w")).alias("_ma"),
                                  (F.sum(F.col("_w") * F.col(label)) / F.sum("_w")).alias("_mb"))
    centred = pairs.join(means, g).select(*g, "_w", (F.col(pred) - F.col("_ma")).alias("_xa"),
                                          (F.col(label) - F.col("_mb")).alias("_xb"))
    pe = _weighted_corr(centred, g, "_xa", "_xb", "_w", "pearson")
    sp = spearman(df, g, pred, label, buckets=buckets, pairs=pairs)
    return pe.join(sp, g).select(*keep, "pearson", "spearmanr",
                                 ((F.col("pearson") + F.col("spearmanr")) / 2).alias("corr"))


def bce_loss(df: DataFrame, group_cols: Sequence[str], y: str = "y", p: str = "p",
             name: str = "loss") -> DataFrame:
    """Mean binary cross-entropy per group (e.g. per batch)."""
    return df.groupBy(*group_cols).agg(F.avg(bce_term(F.col(y).cast("double"), F.col(p))).alias(name))


def ce_loss_2class(df: DataFrame, group_cols: Sequence[str], z: str = "z", y: str = "y",
                   name: str = "loss") -> DataFrame:
    """Mean 2-class cross-entropy on raw scores ``z`` (array of 2) per group."""
    zc = F.col(z)
    return df.groupBy(*group_cols).agg(
        F.avg(ce_term_2class(F.get(zc, 0), F.get(zc, 1), F.col(y))).alias(name))


def alignment_check(preds: DataFrame, labels: DataFrame, key_cols: Sequence[str],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Predictions and labels must pair up one to one: full outer join on the
    key, then count the rows missing on either side per group."""
    k, g = list(key_cols), list(group_cols)
    p = preds.select(*k, *[F.col(c).alias(f"_p_{c}") for c in g], F.lit(1).alias("_has_p"))
    lab = labels.select(*k, *[F.col(c).alias(f"_l_{c}") for c in g], F.lit(1).alias("_has_l"))
    j = p.join(lab, k, "full_outer")
    grp = [F.coalesce(F.col(f"_p_{c}"), F.col(f"_l_{c}")).alias(c) for c in g]
    return j.groupBy(*grp).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_has_l").isNull()).alias("n_missing_label"),
        F.count_if(F.col("_has_p").isNull()).alias("n_missing_pred"),
    )


def paired(preds: DataFrame, labels: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Predictions joined with their labels by key, as the metrics need them; a
    prediction without a label or a label without a prediction fails the job."""
    k = list(key_cols)
    j = preds.withColumn("_has_p", F.lit(1)).join(labels.withColumn("_has_l", F.lit(1)), k, "full_outer")
    told = F.concat(F.lit("predictions and labels differ in length at "), F.concat_ws(", ", *[F.col(c).cast("string") for c in k]))
    ok = F.col("_has_p").isNotNull() & F.col("_has_l").isNotNull()
    # the check is a filter over every row, so that no optimisation drops it
    return j.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))).drop("_has_p", "_has_l")


# ---------------------------------------------------------------------------
# Task dispatch (which metrics a task reports). The task names
# and the metric sets each task reports.
# ---------------------------------------------------------------------------
TASK_METRICS: dict[str, tuple[str, ...]] = {
    "cola": ("mcc",),
    "sst-2": ("acc",),
    "mrpc": ("acc", "f1", "acc_and_f1"),
    "sts-b": ("pearson", "spearmanr", "corr"),
    "qqp": ("acc", "f1", "acc_and_f1"),
    "mnli": ("acc",),
    "mnli-mm": ("acc",),
    "qnli": ("acc",),
    "rte": ("acc",),
    "wnli": ("acc",),
    "hans": ("acc",),
    "boolq": ("acc",),
    "abuse": ("acc",),
}
XNLI_METRICS: dict[str, tuple[str, ...]] = {"xnli": ("acc",)}
REGRESSION_METRICS = ("pearson", "spearmanr", "corr")


@dataclass(frozen=True)
class SummedMetric:
    """A metric that no built-in aggregate gives: ``partial(pred, label)`` turns a batch of
    numpy arrays into a vector of fixed length, the vectors of all batches are added up,
    and ``finish(vector)`` is the value. So no group is ever held whole."""
    partial: Callable[[np.ndarray, np.ndarray], np.ndarray]
    finish: Callable[[np.ndarray], float]


CLASSIFICATION_METRICS = ("acc", "f1", "acc_and_f1", "mcc")
#: Metrics beyond the built-in ones: an aggregate of (pred, label), or a ``SummedMetric``.
METRICS: dict[str, Callable[[Column, Column], Column] | SummedMetric] = {}


def register_metric(name: str, builder: Callable[[Column, Column], Column] | SummedMetric) -> None:
    """Add a metric that task metric sets may name: a function of the prediction and
    label columns that returns an aggregate column, or a ``SummedMetric``."""
    if name in (*CLASSIFICATION_METRICS, *REGRESSION_METRICS):
        raise ValueError(f"{name} is a built-in metric")
    METRICS[name] = builder


def register_task_metrics(task: str, metrics: Sequence[str]) -> None:
    """Add or replace a task's metric set (the pluggable-metric hook); KeyError for a
    metric that is neither built in nor registered."""
    for m in metrics:
        if m not in (*CLASSIFICATION_METRICS, *REGRESSION_METRICS, *METRICS):
            raise KeyError(m)
    TASK_METRICS[task] = tuple(metrics)


def registered_metrics(df: DataFrame, task_col: str, pred: str, label: str, wanted: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """``task_col, metric, value`` of the registered metrics in ``wanted`` (metrics of each
    task): one aggregation for all built by columns, one pass for all summed ones; None
    where no task names one."""
    names = sorted({m for ms in wanted.values() for m in ms if m in METRICS})
    plain = [m for m in names if not isinstance(METRICS[m], SummedMetric)]
    summed = [m for m in names if m not in plain]

    def rows_of(metrics: Sequence[str]) -> DataFrame:
        return df.filter(F.col(task_col).isin([t for t, ms in wanted.items() if set(ms) & set(metrics)]))

    out = []
    if plain:
        built = [METRICS[m](F.col(pred), F.col(label)).cast("double").alias(m) for m in plain]
        out.append(rows_of(plain).groupBy(task_col).agg(*built).unpivot([task_col], plain, "metric", "value"))
    if summed:
        partials = {m: METRICS[m].partial for m in summed}
        finishes = {m: METRICS[m].finish for m in summed}
        own = {t: [m for m in ms if m in partials] for t, ms in wanted.items()}

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[str, str], np.ndarray] = {}
            for b in batches:
                tasks = b.column(0).dictionary_encode()
                code, p, y = tasks.indices.to_numpy(), *(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                for i, t in enumerate(tasks.dictionary.to_pylist()):
                    for m in own[t]:
                        v = np.asarray(partials[m](p[code == i], y[code == i]), np.float64)
                        held[t, m] = held[t, m] + v if (t, m) in held else v
            yield pa.RecordBatch.from_pylist([{task_col: t, "metric": m, "i": i, "v": float(x)} for (t, m), v in held.items()
                                              for i, x in enumerate(v)], pa.schema([(task_col, pa.string()), ("metric", pa.string()),
                                                                                    ("i", pa.int32()), ("v", pa.float64())]))

        def finish(metric: pa.Array, vectors: pa.Array) -> pa.Array:
            return pa.array([float(finishes[m.as_py()](v.values.to_numpy(zero_copy_only=False))) for m, v in zip(metric, vectors)],
                            pa.float64())

        parts = rows_of(summed).select(F.col(task_col).cast("string"), F.col(pred).cast("double"), F.col(label).cast("double")).mapInArrow(
            sums, f"{task_col} string, metric string, i int, v double")
        vectors = (parts.groupBy(task_col, "metric", "i").agg(F.sum("v").alias("v")).groupBy(task_col, "metric")
                   .agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("vs")))  # as long as the metric's vector
        out.append(vectors.select(task_col, "metric", F.arrow_udf(finish, "double")(
            "metric", F.transform("vs", lambda x: x["v"])).alias("value")))
    return reduce(DataFrame.unionByName, out) if out else None


def metrics_for(task: str, table: dict[str, tuple[str, ...]] | None = None) -> tuple[str, ...]:
    table = TASK_METRICS if table is None else table
    if task not in table:
        raise KeyError(task)
    return table[task]


def _classification_stats(df: DataFrame, g: list[str], pred: str, label: str) -> DataFrame:
    pc, lc = F.col(pred), F.col(label)
    conf = df.groupBy(*g).agg(
        F.count_if((pc == 1) & (lc == 1)).alias("tp"), F.count_if((pc == 1) & (lc != 1)).alias("fp"),
        F.count_if((pc != 1) & (lc == 1)).alias("fn"), F.count_if((pc != 1) & (lc != 1)).alias("tn"),
        F.count(F.lit(1)).alias("n"), F.count_if(pc == lc).alias("correct"))
    acc = F.col("correct") / F.col("n")
    return conf.select(*g, acc.alias("acc"), f1_expr().alias("f1"), ((acc + f1_expr()) / 2).alias("acc_and_f1"),
                       mcc_expr().alias("mcc"))


def compute_task_metrics(df: DataFrame, task: str, pred: str = "pred", label: str = "label",
                         table: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Metrics of one task as a long table (metric, value). Unknown task -> KeyError."""
    wanted = metrics_for(task, table)
    out = []
    if mine := [m for m in wanted if m in CLASSIFICATION_METRICS]:
        out.append(_classification_stats(df, [], pred, label).unpivot([], mine, "metric", "value"))
    if mine := [m for m in wanted if m in REGRESSION_METRICS]:
        out.append(pearson_and_spearman(df, [], pred, label).unpivot([], mine, "metric", "value"))
    if [m for m in wanted if m in METRICS]:
        out.append(registered_metrics(df.withColumn("_task", F.lit(task)), "_task", pred, label, {task: wanted}).drop("_task"))
    return reduce(DataFrame.unionByName, out)


def task_metrics(df: DataFrame, task_col: str = "task", pred: str = "pred", label: str = "label",
                 table: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Metrics for many tasks at once: one aggregation for the classification
    tasks, one for the regression tasks, those of ``register_metric``, then each task
    keeps its own metric set. A task without an entry fails the job (``raise_error``)."""
    table = TASK_METRICS if table is None else table
    spark = df.sparkSession
    spec = spark.createDataFrame([(t, m) for t, ms in table.items() for m in ms],
                                 f"{task_col} string, metric string")
    reg_tasks = [t for t, ms in table.items() if set(ms) & set(REGRESSION_METRICS)]
    reg_only = [t for t in reg_tasks if not set(table[t]) & set(CLASSIFICATION_METRICS)]
    is_reg = F.col(task_col).isin(reg_tasks)
    cls = _classification_stats(df.filter(~F.col(task_col).isin(reg_only)), [task_col], pred, label) \
        .unpivot([task_col], ["acc", "f1", "acc_and_f1", "mcc"], "metric", "value")
    reg = pearson_and_spearman(df.filter(is_reg), [task_col], pred, label) \
        .unpivot([task_col], list(REGRESSION_METRICS), "metric", "value")
    more = registered_metrics(df, task_col, pred, label, table)
    computed = cls.unionByName(reg) if more is None else cls.unionByName(reg).unionByName(more)
    # the registry is a handful of rows: safe to broadcast
    want = F.broadcast(spec.withColumn("_want", F.lit(True)))
    known = F.broadcast(spec.select(task_col).distinct().withColumn("_known", F.lit(True)))
    j = computed.join(want, [task_col, "metric"], "left").join(known, task_col, "left")
    keep = F.when(F.col("_known").isNull(),
                  F.raise_error(F.concat(F.lit("KeyError: "), F.col(task_col))).cast("boolean")) \
        .otherwise(F.col("_want").isNotNull())
    return j.filter(keep).select(task_col, "metric", "value")

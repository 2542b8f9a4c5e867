"""Registered queries: each is a Spark plan over the given tables, paired
(where SQL can say the same) with an ANSI SQL oracle for DuckDB.

Conventions shared by both sides: doubles rounded to 6 places, counts bigint,
epochs int, every computed column aliased to the same name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelkiln.functions.columns import linspace, rounded
from labelkiln.operators import metrics as M
from labelkiln.operators import sampling as SA
from labelkiln.operators import selection as S
from labelkiln.operators.draws import weighted_draws
from labelkiln.operators.ordering import order_key, rank_by_key
from labelkiln.plans import derived as D
from labelkiln.plans import sql_common as Q
from labelkiln.session import cut_lineage

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# evaluation groups: every split can be evaluated (val is the reference's)
G = ["split", "encoder", "label_name", "epoch"]
THRESHOLD = 0.48
SWEEP_LABEL, SWEEP_START, SWEEP_STOP, SWEEP_NUM = "IsAbuse", 0.45, 0.55, 26
SHUFFLE_SEED = 42
BATCH_SIZE = 10


def _predicted(spark, sf):
    return D.scored(spark, sf).withColumn("pred", M.predict("p", THRESHOLD))


def _confusion(spark, sf):
    return M.confusion(_predicted(spark, sf), G)


# ---------------------------------------------------------------- metrics --
@register("confusion_by_label", Q.q_confusion_by_label())
def confusion_by_label(spark, sf):
    return _confusion(spark, sf)


@register("accuracy_f1_by_label", Q.q_accuracy_f1_by_label())
def accuracy_f1_by_label(spark, sf):
    return rounded(M.accuracy_f1(_confusion(spark, sf), G))


@register("acc_and_f1", Q.q_acc_and_f1())
def acc_and_f1(spark, sf):
    return rounded(M.acc_and_f1(_confusion(spark, sf), G))


@register("mcc", Q.q_mcc())
def mcc(spark, sf):
    return rounded(_confusion(spark, sf).select(*G, M.mcc_expr().alias("mcc")))


def _auc_history(spark, sf):
    return M.roc_auc(D.scored(spark, sf), G)


@register("roc_auc_by_label", Q.q_roc_auc_by_label())
def roc_auc_by_label(spark, sf):
    return rounded(_auc_history(spark, sf))


@register("pearson_spearman", Q.q_pearson_spearman())
def pearson_spearman(spark, sf):
    return rounded(M.pearson_and_spearman(D.regression_predictions(spark, sf), ["task"], "pred", "label"))


@register("task_metrics_dispatch", Q.q_task_metrics_dispatch())
def task_metrics_dispatch(spark, sf):
    table = {**M.TASK_METRICS, **M.XNLI_METRICS}
    return rounded(M.task_metrics(D.task_predictions(spark, sf), "task", "pred", "label", table=table))


def _class_pairs(pred, label):
    """Counts of (prediction, label) over the classes 0 to 2."""
    return np.bincount((3 * pred + label).astype(np.int64), minlength=9)


def _kappa(counts):
    """Agreement beyond chance."""
    m = counts.reshape(3, 3) / counts.sum()
    chance = m.sum(axis=0) @ m.sum(axis=1)
    return (np.trace(m) - chance) / (1 - chance) if chance < 1 else 0.0


M.register_metric("balanced_acc", lambda pred, label: (F.avg(F.when(label == 1, (pred == label).cast("int")))
                                                       + F.avg(F.when(label != 1, (pred == label).cast("int")))) / 2)
M.register_metric("mae", lambda pred, label: F.avg(F.abs(pred - label)))
M.register_metric("kappa", M.SummedMetric(_class_pairs, _kappa))


@register("task_metrics_custom", Q.q_task_metrics_custom())
def task_metrics_custom(spark, sf):
    """X3: metric sets with metrics that a caller registered."""
    table = {**M.TASK_METRICS, **M.XNLI_METRICS, "cola": ("mcc", "balanced_acc"), "mnli": ("acc", "kappa"),
             "xnli": ("kappa",), "sts-b": ("pearson", "mae")}
    got = M.task_metrics(D.task_predictions(spark, sf), "task", "pred", "label", table=table)
    return rounded(got.filter(F.col("task").isin("cola", "mnli", "xnli", "sts-b") & ~F.col("metric").isin("mcc", "pearson")))


@register("pred_label_alignment_check", Q.q_pred_label_alignment_check())
def pred_label_alignment_check(spark, sf):
    """Per split, label, encoder and epoch: keys, and the rows that one side lacks
    (the fixture drops every 7th document's predictions and every 11th's labels)."""
    every = D.scored(spark, sf).select("doc_id", "split", "label_name", "encoder", "epoch")
    return M.alignment_check(every.filter(F.col("doc_id") % 7 != 0), every.filter(F.col("doc_id") % 11 != 0),
                             ["doc_id", "label_name", "encoder", "epoch"], ["split", "label_name", "encoder", "epoch"])


@register("paired_accuracy_f1", Q.q_accuracy_f1_by_label())
def paired_accuracy_f1(spark, sf):
    """Accuracy and F1 of predictions joined with their labels by key; a row that
    one side lacks would fail the job."""
    key = ["doc_id", "label_name", "encoder", "epoch"]
    s = D.scored(spark, sf)
    both = M.paired(s.select(*key, "p"), s.select(*key, "split", "y"), key)
    g = ["split", "encoder", "label_name", "epoch"]
    return rounded(M.accuracy_f1(M.confusion(both.withColumn("pred", M.predict("p", THRESHOLD)), g), g))


# ----------------------------------------------------------------- losses --
def _train_batches(spark, sf):
    """Train rows in seeded shuffle order with their batch number."""
    c = D.comments(spark, sf).filter(F.col("split") == "train").select("doc_id", "split")
    c = cut_lineage(c.withColumn("_key", order_key(SHUFFLE_SEED, "doc_id")), "keys")
    idx = rank_by_key(c, ["split"], ["_key", "doc_id"], "row_idx")
    return idx.select("doc_id", "row_idx", F.floor(F.col("row_idx") / BATCH_SIZE).cast("bigint").alias("batch_id"))


def _bce_history(spark, sf):
    s = D.scored(spark, sf).filter(F.col("split") == "train")
    b = _train_batches(spark, sf)
    return M.bce_loss(s.join(b, "doc_id"), ["encoder", "label_name", "epoch", "batch_id"])


@register("bce_loss_by_batch", Q.q_bce_loss_by_batch())
def bce_loss_by_batch(spark, sf):
    return rounded(_bce_history(spark, sf))


@register("bce_loss_resampled_batches", Q.q_bce_loss_resampled_batches())
def bce_loss_resampled_batches(spark, sf):
    """E2 as one flow: class-balanced resample -> batches of 10 -> loss per
    batch, encoder, label and epoch (a row drawn twice counts twice)."""
    drawn = SA.batches(SA.weighted_resample(_train_long(spark, sf), "doc_id", "row_idx", SHUFFLE_SEED), "draw", BATCH_SIZE)
    s = D.scored(spark, sf).filter(F.col("split") == "train").select("doc_id", "label_name", "encoder", "epoch", "y", "p")
    both = drawn.select("doc_id", "label_name", "batch_id").join(s, ["doc_id", "label_name"])
    return rounded(M.bce_loss(both, ["encoder", "label_name", "epoch", "batch_id"]))


@register("ce_loss_by_batch", Q.q_ce_loss_by_batch())
def ce_loss_by_batch(spark, sf):
    from labelkiln.operators.models import two_class_head
    e = D.table(spark, sf, "embeddings")
    e = e.withColumn("_key", order_key(SHUFFLE_SEED, "vec_id")).withColumn("_g", F.lit(0))
    idx = rank_by_key(e, ["_g"], ["_key", "vec_id"], "row_idx")
    z = idx.select(F.floor(F.col("row_idx") / BATCH_SIZE).cast("bigint").alias("batch_id"),
                   (F.col("label") % 2).alias("y"), two_class_head(F.col("embedding")).alias("z"))
    return rounded(M.ce_loss_2class(z, ["batch_id"], "z", "y"))


@register("loss_tail_50", Q.q_loss_tail(50))
def loss_tail_50(spark, sf):
    return rounded(S.tail(_bce_history(spark, sf), ["encoder", "label_name"], ["epoch", "batch_id"], 50))


@register("loss_tail_10", Q.q_loss_tail(10))
def loss_tail_10(spark, sf):
    return rounded(S.tail(_bce_history(spark, sf), ["encoder", "label_name"], ["epoch", "batch_id"], 10))


# -------------------------------------------------------------- selection --
def _sweep(spark, sf):
    s = D.scored(spark, sf).filter(F.col("label_name") == SWEEP_LABEL)
    grid = linspace(SWEEP_START, SWEEP_STOP, SWEEP_NUM)
    return S.threshold_sweep(s, ["split", "encoder", "epoch"], grid)


@register("threshold_sweep_f1", Q.q_threshold_sweep_f1(SWEEP_LABEL, SWEEP_START, SWEEP_STOP, SWEEP_NUM))
def threshold_sweep_f1(spark, sf):
    return rounded(_sweep(spark, sf))


def _mean_f1(spark, sf):
    return S.mean_over(_sweep(spark, sf), ["split", "encoder", "threshold"], "f1", "mean_f1")


@register("threshold_mean_f1", Q.q_threshold_mean_f1(SWEEP_LABEL, SWEEP_START, SWEEP_STOP, SWEEP_NUM))
def threshold_mean_f1(spark, sf):
    return rounded(_mean_f1(spark, sf))


@register("best_threshold", Q.q_best_threshold(SWEEP_LABEL, SWEEP_START, SWEEP_STOP, SWEEP_NUM))
def best_threshold(spark, sf):
    return rounded(S.best_threshold(_mean_f1(spark, sf), ["split", "encoder"]))


def _history(spark, sf):
    """Long metric history: split, encoder, label_name, epoch, metric, value."""
    conf = _confusion(spark, sf)
    af = M.accuracy_f1(conf, G).join(_auc_history(spark, sf), G)
    return af.unpivot(G, ["acc", "f1", "roc_auc"], "metric", "value")


@register("running_best_epoch", Q.q_running_best_epoch())
def running_best_epoch(spark, sf):
    h = _auc_history(spark, sf).withColumnRenamed("roc_auc", "value")
    return rounded(S.running_best(h, ["split", "encoder", "label_name"]))


@register("best_epoch", Q.q_best_epoch())
def best_epoch(spark, sf):
    h = _history(spark, sf)
    return rounded(S.first_argmax(h, ["split", "encoder", "label_name", "metric"]))


@register("metric_history_arrays", Q.q_metric_history_arrays())
def metric_history_arrays(spark, sf):
    h = rounded(_history(spark, sf))
    return S.history_arrays(h, ["split", "encoder", "label_name", "metric"])


@register("encoder_pivot", Q.q_encoder_pivot())
def encoder_pivot(spark, sf):
    h = rounded(_history(spark, sf))
    return S.pivot_by(h, ["split", "label_name", "metric", "epoch"], "encoder", list(D.ENCODERS))


# --------------------------------------------------------------- sampling --
LIMITS = {"train": 30000, "val": 3500, "test": 3500}


def _shuffled(spark, sf, limits=None):
    return SA.shuffle_limit(D.comments(spark, sf), "doc_id", SHUFFLE_SEED, "split", limits)


def _train_long(spark, sf, limits=None):
    """Training rows in long form (all of them unless ``limits`` are passed);
    read by several aggregations, so written once."""
    t = _shuffled(spark, sf, limits).filter(F.col("split") == "train").drop("comment_text")
    return cut_lineage(t.unpivot(["doc_id", "row_idx"], list(D.LABEL_NAMES), "label_name", "y"), "train")


@register("shuffle_limit", Q.q_shuffle_limit())
def shuffle_limit(spark, sf):
    return _shuffled(spark, sf, LIMITS).select("split", "doc_id", "row_idx")


@register("batches_of_10", Q.q_batches_of_10())
def batches_of_10(spark, sf):
    return SA.batches(_shuffled(spark, sf), "row_idx", BATCH_SIZE).select("split", "doc_id", "row_idx", "batch_id")


@register("class_counts", Q.q_class_counts())
def class_counts(spark, sf):
    return SA.class_counts(_train_long(spark, sf))


@register("class_weights", Q.q_class_weights())
def class_weights(spark, sf):
    return rounded(SA.class_weights(SA.class_counts(_train_long(spark, sf))))


@register("row_weights", Q.q_row_weights())
def row_weights(spark, sf):
    tl = _train_long(spark, sf)
    w = SA.class_weights(SA.class_counts(tl))
    return rounded(SA.row_weights(tl, w).select("doc_id", "label_name", "y", "weight"))


@register("weighted_resample", Q.q_weighted_resample())
def weighted_resample(spark, sf):
    r = SA.weighted_resample(_train_long(spark, sf), "doc_id", "row_idx", SHUFFLE_SEED)
    return SA.batches(r, "draw", BATCH_SIZE)


def _any_weights(spark, sf):
    """Labelled rows with weights of very different size: the text's length, four times
    that for class 1, and for each label's smallest id as much as all others together."""
    c = D.comments(spark, sf).select("doc_id", "split", F.length("comment_text").alias("size"), *D.LABEL_NAMES)
    long = c.unpivot(["doc_id", "split", "size"], list(D.LABEL_NAMES), "label_name", "y")
    long = cut_lineage(long.withColumn("weight", (F.col("size") * (1 + 3 * F.col("y"))).cast("double")), "weights")
    first = long.groupBy("label_name").agg(F.min("doc_id").alias("first"), F.sum("weight").alias("total"), F.count("*").alias("n"),
                                           F.min_by("weight", "doc_id").alias("own"))
    heavy = F.col("doc_id") == F.col("first")
    return long.join(first, "label_name").select("label_name", "doc_id", "y", "n", heavy.alias("heavy"), F.when(
        heavy, F.col("total") - F.col("own")).otherwise(F.col("weight")).alias("weight"))


@register("weighted_resample_any", Q.q_weighted_resample_any())
def weighted_resample_any(spark, sf):
    """Per label, as many draws as it has rows by arbitrary weights: their number and
    numbering, and whether the shares of the heavy row and of eight kinds of rows lie
    within five standard deviations of what the weights say."""
    rows = cut_lineage(_any_weights(spark, sf), "weighted")
    drawn = weighted_draws(rows, "doc_id", "weight", ["label_name"], rows.groupBy("label_name").agg(
        F.count("*").alias("n")), SHUFFLE_SEED)
    kind = F.when(F.col("heavy"), F.lit(-1)).otherwise(F.col("doc_id") % 4 + 4 * F.col("y"))
    own = rows.select("label_name", "doc_id", "weight", kind.alias("kind"))
    of_kind = own.groupBy("label_name", "kind").agg(F.sum("weight").alias("w"))
    got = cut_lineage(drawn.join(own.drop("weight"), ["label_name", "doc_id"], "left"), "drawn")
    counts = got.groupBy("label_name", "kind").agg(F.count("*").alias("k"))
    all_ = got.groupBy("label_name").agg(F.count("*").alias("n_draws"), F.count_distinct("draw").alias("n_numbers"),
                                         F.max("draw").alias("last"), F.count_if(F.col("kind").isNull()).alias("n_unknown"))
    weight = of_kind.groupBy("label_name").agg(F.sum("w").alias("total"))
    p, n = F.col("w") / F.col("total"), F.col("n_draws")
    near = F.abs(F.coalesce("k", F.lit(0)) - n * p) <= 5 * F.sqrt(n * p * (1 - p)) + 1
    told = (of_kind.join(counts, ["label_name", "kind"], "left").join(all_, "label_name").join(weight, "label_name")
            .groupBy("label_name").agg(F.bool_and(near).alias("shares_near")))
    return all_.join(told, "label_name").select("label_name", "n_draws", "n_numbers", "last", "n_unknown", "shares_near")


@register("label_vectors", Q.q_label_vectors())
def label_vectors(spark, sf):
    return SA.label_vectors(D.comments(spark, sf), D.LABEL_NAMES).select("doc_id", "split", "labels")




# ------------------------------------------------------------- report sink --
@register("metric_history_sink", Q.q_metric_history_sink())
def metric_history_sink(spark, sf):
    """K3: the metric history written partitioned by label and read back."""
    from labelkiln.session import fresh_dir
    path = fresh_dir(spark, "history") + "/history"
    rounded(_history(spark, sf)).write.partitionBy("label_name").parquet(path)
    return spark.read.parquet(path).select("split", "encoder", "label_name", "epoch", "metric", "value")


@register("metrics_report", Q.q_metrics_report())
def metrics_report(spark, sf):
    """K3 as one table per (encoder, label): acc, F1 and ROC-AUC per epoch on
    the validation split, and the last 50 training batch losses in step order."""
    h = rounded(_history(spark, sf).filter(F.col("split") == "val"))
    arrays = S.history_arrays(h, ["encoder", "label_name", "metric"])
    wide = arrays.groupBy("encoder", "label_name").pivot("metric", ["acc", "f1", "roc_auc"]).agg(F.first("values"))
    tail = rounded(S.tail(_bce_history(spark, sf), ["encoder", "label_name"], ["epoch", "batch_id"], 50))
    losses = tail.groupBy("encoder", "label_name").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("epoch", "batch_id", "loss"))), lambda s: s["loss"])
        .alias("last_losses"))
    return wide.join(losses, ["encoder", "label_name"]).select(
        "encoder", "label_name", F.col("acc").alias("acc_by_epoch"), F.col("f1").alias("f1_by_epoch"),
        F.col("roc_auc").alias("roc_auc_by_epoch"), "last_losses")


SWEEP_LIMITS = {"train": 4500, "val": 500, "test": 500}


@register("shuffle_limit_sweep", Q.q_shuffle_limit_with(4500, 500, 500))
def shuffle_limit_sweep(spark, sf):
    """L1/L2 with the threshold-sweep run's smaller limits."""
    s = SA.shuffle_limit(D.comments(spark, sf), "doc_id", SHUFFLE_SEED, "split", SWEEP_LIMITS)
    return s.select("split", "doc_id", "row_idx")


BINDING_LIMITS = {"train": 100, "val": 10, "test": 10}


@register("shuffle_limit_binding", Q.q_shuffle_limit_with(100, 10, 10))
def shuffle_limit_binding(spark, sf):
    """L1/L2 with limits below the row counts, so that they bind."""
    return _shuffled(spark, sf, BINDING_LIMITS).select("split", "doc_id", "row_idx")


# the committed sweep script's configuration (another label and a wider grid)
WIDE_LABEL, WIDE_START, WIDE_STOP, WIDE_NUM = "toxic", 0.45, 0.70, 26


@register("best_threshold_toxic_wide", Q.q_best_threshold(WIDE_LABEL, WIDE_START, WIDE_STOP, WIDE_NUM))
def best_threshold_toxic_wide(spark, sf):
    s = D.scored(spark, sf).filter(F.col("label_name") == WIDE_LABEL)
    sweep = S.threshold_sweep(s, ["split", "encoder", "epoch"], linspace(WIDE_START, WIDE_STOP, WIDE_NUM))
    mean = S.mean_over(sweep, ["split", "encoder", "threshold"], "f1", "mean_f1")
    return rounded(S.best_threshold(mean, ["split", "encoder"]))


# the reader / feature / head and model-fitting queries register themselves
from labelkiln.plans import text_queries  # noqa: E402,F401  (registers reader/feature/head queries)
from labelkiln.plans import model_queries  # noqa: E402,F401  (registers model-fitting queries)

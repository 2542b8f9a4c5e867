"""Model-fitting queries. Fitted weights have no SQL form; the queries with SQL check what
follows from them (rows, falling losses, F1 above any constant model, recounts, reloads)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from labelkiln.functions.columns import linspace
from labelkiln.operators import metrics as M
from labelkiln.operators import minibatch as MB
from labelkiln.operators import models as MO
from labelkiln.operators import sampling as SA
from labelkiln.operators import selection as S
from labelkiln.operators.draws import weighted_draws
from labelkiln.operators.model_store import ModelStore
from labelkiln.plans import derived as D
from labelkiln.plans import sql_common as Q
from labelkiln.plans.catalog import THRESHOLD, register
from labelkiln.session import cut_lineage, fresh_dir

EPOCHS = 5
#: Bound on the labelled rows the perceptron is fitted on, per split.
MAX_FIT_ROWS = {"train": 30000, "val": 3500, "test": 3500}
NUM_FEATURES = 4096


def _long_with_text(spark, sf):
    lab = D.labelled(spark, sf, with_text=True)
    train = lab.filter(F.col("split") == "train")
    w = SA.class_weights(SA.class_counts(train))
    return SA.row_weights(train, w), lab.filter(F.col("split") != "train")


def _feature_model(spark, docs):
    docs = docs.select("doc_id", "comment_text").dropDuplicates(["doc_id"])
    return MO.text_feature_pipeline("comment_text", NUM_FEATURES).fit(docs)


def _prepared(spark, sf):
    """Feature model fitted on train texts; every document featurized once, and the labels
    unpivoted from that table."""
    docs = D.comments(spark, sf)
    fm = _feature_model(spark, docs.filter(F.col("split") == "train"))
    feats = cut_lineage(fm.transform(docs).select("doc_id", "split", *D.LABEL_NAMES, "features"), "features")
    long = feats.unpivot(["doc_id", "split", "features"], list(D.LABEL_NAMES), "label_name", "y")
    train = long.filter(F.col("split") == "train")
    weights = cut_lineage(SA.class_weights(SA.class_counts(train)), "weights")  # read by every fit
    weighted = SA.row_weights(train, weights)
    cols = ["doc_id", "label_name", F.col("y").cast("double").alias("label"), "features"]
    return fm, weighted.select(*cols, "weight"), long.filter(F.col("split") != "train").select(*cols, "split")


def _epoch_fits(spark, sf):
    """Fits with maxIter = 1..EPOCHS per label; every fit scores the held-out
    rows and is tagged with its epoch."""
    fm, train_f, held_f = _prepared(spark, sf)
    scored, losses = None, []
    for e in range(1, EPOCHS + 1):
        heads, _, hist = MO.fit_per_label(train_f, fm, D.LABEL_NAMES, max_iter=e)
        s = MO.score_per_label(heads, held_f, ["doc_id", "split"]).withColumn("epoch", F.lit(e))
        scored = s if scored is None else scored.unionByName(s)
        losses += [(name, e, i, float(v)) for name, h in hist.items() for i, v in enumerate(h)]
    return scored, losses


@register("fit_label_classifiers")
def fit_label_classifiers(spark, sf):
    """M1: one weighted classifier per label on the train split, scoring
    every held-out row: doc_id, split, label_name, y, p."""
    fm, train_f, held_f = _prepared(spark, sf)
    heads, _, _ = MO.fit_per_label(train_f, fm, D.LABEL_NAMES, max_iter=EPOCHS)
    return MO.score_per_label(heads, held_f, ["doc_id", "split"])


@register("epoch_metrics_from_fits")
def epoch_metrics_from_fits(spark, sf):
    """M3/M4: acc, F1 (threshold 0.48) and ROC-AUC per split, label and epoch."""
    scored, _ = _epoch_fits(spark, sf)
    g = ["split", "label_name", "epoch"]
    conf = M.confusion(scored.withColumn("pred", M.predict("p", THRESHOLD)), g)
    return M.accuracy_f1(conf, g).join(M.roc_auc(scored, g), g)


class _PooledLabels:
    """Pooled vectors of the documents with their labels, one row a document, written once
    and read by every fit; ``of(label)`` has the train rows with the weight of their class."""

    def __init__(self, spark, sf):
        from labelkiln.plans.text_queries import pooled_documents
        docs = D.comments(spark, sf).drop("comment_text")
        lab = docs.unpivot(["doc_id", "split"], list(D.LABEL_NAMES), "label_name", "y")
        self.weights = cut_lineage(SA.class_weights(SA.class_counts(lab.filter(F.col("split") == "train"))).select(
            "label_name", "y", "weight"), "weights")
        self.rows = cut_lineage(docs.join(pooled_documents(spark, sf, "pad", D.table(spark, sf, "labels")), "doc_id"), "pooled")

    def of(self, name):
        w = F.broadcast(self.weights.filter(F.col("label_name") == name).select("y", "weight"))
        return self.rows.select("doc_id", "split", F.lit(name).alias("label_name"), F.col(name).alias("y"), "pooled").join(w, "y", "left")


@register("fit_pooled_classifier")
def fit_pooled_classifier(spark, sf):
    """M2: pooled token vectors -> 2-class model per label -> arg-max class."""
    lab = _PooledLabels(spark, sf)
    out = None
    for name in D.LABEL_NAMES:
        rows = lab.of(name)
        m = MO.fit_pooled_classifier(rows.filter(F.col("split") == "train"), weight_col="weight")
        part = MO.argmax_scores(m, rows.filter(F.col("split") != "train"), keep_cols=["doc_id", "split",
                                                                                       "label_name"])
        out = part if out is None else out.unionByName(part)
    return out


@register("model_round_trip")
def model_round_trip(spark, sf):
    """K2: keep the first-best epoch per label (by ROC-AUC on val), save that
    model (feature stages + classifier), load it back and re-score the raw val
    rows: label_name, best_epoch, n_rows, n_equal."""
    from pyspark.ml import PipelineModel
    fm, train_f, held_f = _prepared(spark, sf)
    val_f = held_f.filter(F.col("split") == "val")
    fits, hist = {}, None
    for e in range(1, EPOCHS + 1):
        heads, pipes, _ = MO.fit_per_label(train_f, fm, D.LABEL_NAMES, max_iter=e)
        fits[e] = (heads, pipes)
        a = M.roc_auc(MO.score_per_label(heads, val_f, ["doc_id"]), ["label_name"]).withColumn("epoch", F.lit(e))
        hist = a if hist is None else hist.unionByName(a)
    best = {r["label_name"]: r["best_epoch"] for r in
            S.first_argmax(hist.withColumnRenamed("roc_auc", "value"), ["label_name"]).collect()}
    _, held = _long_with_text(spark, sf)
    val_raw = held.filter(F.col("split") == "val").withColumn("label", F.col("y").cast("double"))
    root = fresh_dir(spark, "models")
    rows = []
    for name, e in best.items():
        heads, pipes = fits[e]
        path = f"{root}/best-{name}"
        pipes[name].write().save(path)
        again = PipelineModel.load(path)
        a = MO.score_per_label({name: heads[name]}, val_f, ["doc_id"]).withColumnRenamed("p", "p1")
        b = MO.score_per_label({name: again}, val_raw, ["doc_id"]).withColumnRenamed("p", "p2")
        j = a.join(b, ["doc_id", "label_name", "y"])
        rows.append(j.agg(F.lit(name).alias("label_name"), F.lit(e).alias("best_epoch"),
                          F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("p1") == F.col("p2")).alias("n_equal")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@register("fit_label_classifiers_rows", Q.q_held_out_rows())
def fit_label_classifiers_rows(spark, sf):
    """M1 seen through what does not depend on the solver: every held-out row and
    label once, with a probability from 0 to 1."""
    s = fit_label_classifiers(spark, sf)
    return s.select("doc_id", "split", "label_name", "y", F.col("p").between(0, 1).alias("in_range"))


@register("fit_pooled_classifier_rows", Q.q_held_out_rows())
def fit_pooled_classifier_rows(spark, sf):
    """M2 seen through its rows: every held-out row and label once, a class 0 or 1."""
    s = fit_pooled_classifier(spark, sf)
    return s.select("doc_id", "split", "label_name", "y", F.col("pred").isin(0, 1).alias("in_range"))


@register("epoch_metrics_rows", Q.q_epoch_metrics_rows())
def epoch_metrics_rows(spark, sf):
    """M4 seen through its rows: one per held-out split, label and epoch, metrics
    from 0 to 1 (no ROC-AUC where a class is missing)."""
    m = epoch_metrics_from_fits(spark, sf)
    ok = F.col("acc").between(0, 1) & F.col("f1").between(0, 1) & F.coalesce(F.col("roc_auc").between(0, 1), F.lit(True))
    return m.select("split", "label_name", "epoch", ok.alias("in_range"))


@register("model_round_trip_rows", Q.q_model_round_trip_rows())
def model_round_trip_rows(spark, sf):
    """K2 seen through its rows: the model read back scores every validation row
    as the model kept in memory does."""
    return model_round_trip(spark, sf).select("label_name", "n_rows", "n_equal")


@register("fit_objective_history")
def fit_objective_history(spark, sf):
    """A17 for fitted models: the training objective per iteration of every
    (label, epoch) fit -- one short list per fit, bounded by maxIter."""
    _, losses = _epoch_fits(spark, sf)
    return spark.createDataFrame(losses, "label_name string, epoch int, iteration int, loss double")


@register("fit_dense_head_mlp")
def fit_dense_head_mlp(spark, sf):
    """M1 with the dense head: per label, a [64, 64, 2] perceptron on pooled
    token vectors, trained on the class-balanced resample of the (shuffled,
    limited) train rows; scores every held-out row: doc_id, split, label_name, y, p."""
    from pyspark.ml.functions import array_to_vector
    from labelkiln.plans.catalog import _train_long
    from labelkiln.plans.text_queries import pooled_documents
    pooled = cut_lineage(pooled_documents(spark, sf, "tokens", D.table(spark, sf, "labels")), "pooled")
    draws = SA.weighted_resample(_train_long(spark, sf, MAX_FIT_ROWS), "doc_id", "row_idx", 42)
    held = D.labelled(spark, sf).filter(F.col("split") != "train").join(pooled, "doc_id")
    out = None
    for name in D.LABEL_NAMES:
        train = draws.filter(F.col("label_name") == name).join(pooled, "doc_id")
        m = MO.fit_dense_head(train)
        rows = held.filter(F.col("label_name") == name).withColumn("features", array_to_vector(F.col("pooled")))
        part = m.transform(rows).select("doc_id", "split", "label_name", "y",
                                        MO.positive_probability().alias("p"))
        out = part if out is None else out.unionByName(part)
    return out


@register("pooled_epoch_metrics")
def pooled_epoch_metrics(spark, sf):
    """The pooled-sequence head run: per label, 2-class fits with maxIter =
    1..EPOCHS on pooled token vectors, arg-max predictions on the held-out
    rows, acc and F1 per (split, label, epoch), and the first epoch with the
    best F1 on the validation split (``best_epoch``, on every row of the label)."""
    lab = _PooledLabels(spark, sf)
    scored = None
    for e in range(1, EPOCHS + 1):
        for name in D.LABEL_NAMES:
            rows = lab.of(name)
            m = MO.fit_pooled_classifier(rows.filter(F.col("split") == "train"), max_iter=e, weight_col="weight")
            part = MO.argmax_scores(m, rows.filter(F.col("split") != "train"),
                                    keep_cols=["doc_id", "split", "label_name"]).withColumn("epoch", F.lit(e))
            scored = part if scored is None else scored.unionByName(part)
    g = ["split", "label_name", "epoch"]
    hist = M.accuracy_f1(M.confusion(scored, g), g)
    best = S.first_argmax(hist.filter(F.col("split") == "val").withColumnRenamed("f1", "value"), ["label_name"])
    return hist.join(best.select("label_name", "best_epoch"), ["label_name"], "left")


# --------------------------------------------------- mini-batch training --
#: Positions of the hashed words for each encoder; steps of an epoch; smallest batch.
ENCODER_DIMS, STEPS, MIN_BATCH = dict(zip(D.ENCODERS, (512, 4096))), 8, 10


def _minibatch_run(spark, sf, encoder):
    """``(run, features)``: one run of all labels and epochs over class-weighted draws
    with replacement (as many an epoch as there are training rows), and the hashed words
    of every labelled document with its split."""
    dim = ENCODER_DIMS[encoder]
    docs = D.comments(spark, sf)
    features = cut_lineage(docs.select("doc_id", "split", *D.LABEL_NAMES, MB.hashed_words(F.col("comment_text"), dim).alias("idx")),
                           "features")
    train = features.filter(F.col("split") == "train").drop("idx").unpivot(["doc_id"], list(D.LABEL_NAMES), "label_name", "y")
    rows = cut_lineage(SA.row_weights(train, SA.class_weights(SA.class_counts(train))), "weighted")
    n = rows.count() // len(D.LABEL_NAMES)
    size = max(MIN_BATCH, -(-n // STEPS))
    draws = weighted_draws(rows, "doc_id", "weight", ["label_name"], rows.select("label_name").distinct().withColumn(
        "n", F.lit(n * EPOCHS)), 42)
    drawn = draws.join(rows.select("label_name", "doc_id", "y"), ["label_name", "doc_id"])
    batches = MB.batch_rows(drawn, features.select("doc_id", "idx"), D.LABEL_NAMES, n, size)
    return MB.train(batches, D.LABEL_NAMES, dim, EPOCHS, -(-n // size)), features


def _scored(run, features, splits):
    """Every document of ``splits`` with its probability per label and epoch. Documents
    meet their labels once, before the labels and epochs become rows."""
    rows = features.filter(F.col("split").isin(*splits))
    y = rows.select("doc_id", "split", F.create_map(*[x for n in D.LABEL_NAMES for x in (F.lit(n), F.col(n))]).alias("ys"))
    both = MB.probabilities(rows, ["doc_id"], run).join(y, "doc_id")
    return MB.each_probability(both, ["doc_id", "split", "ys"], D.LABEL_NAMES).select(
        "doc_id", "label_name", "epoch", "p", "split", F.col("ys")[F.col("label_name")].alias("y"))


@register("minibatch_epoch_metrics")
def minibatch_epoch_metrics(spark, sf):
    """M1, M3, M4: acc, F1 (threshold 0.48) and ROC-AUC per split, label and epoch of one
    run, epoch after epoch with the optimizer's state kept."""
    run, features = _minibatch_run(spark, sf, "tuned")
    scored = cut_lineage(_scored(run, features, ("train", "val", "test")), "scored")
    g = ["split", "label_name", "epoch"]
    conf = M.confusion(scored.withColumn("pred", M.predict("p", THRESHOLD)), g)
    return M.accuracy_f1(conf, g).join(M.roc_auc(scored, g), g)


@register("minibatch_loss_history")
def minibatch_loss_history(spark, sf):
    """A17: the loss of every batch before its step (epochs x steps x labels rows)."""
    run, _ = _minibatch_run(spark, sf, "tuned")
    return spark.createDataFrame(run.losses, "epoch int, step int, label_name string, loss double")


@register("minibatch_checks", Q.q_minibatch_checks())
def minibatch_checks(spark, sf):
    """What no constant model can give: a falling loss, and an F1 on the training rows
    above that of calling everything positive (the best a constant can do)."""
    run, features = _minibatch_run(spark, sf, "tuned")
    losses = spark.createDataFrame(run.losses, "epoch int, step int, label_name string, loss double").groupBy("label_name").agg(
        F.avg(F.when(F.col("epoch") == 1, F.col("loss"))).alias("first"),
        F.avg(F.when(F.col("epoch") == EPOCHS, F.col("loss"))).alias("last"))
    scored = _scored(run, features, ("train",)).filter(F.col("epoch") == EPOCHS)
    f1 = M.accuracy_f1(M.confusion(scored.withColumn("pred", M.predict("p", THRESHOLD)), ["label_name"]), ["label_name"])
    base = scored.groupBy("label_name").agg(F.avg("y").alias("share"))
    better = (F.col("share") == 0) | (F.col("f1") > 2 * F.col("share") / (1 + F.col("share")))
    return (losses.join(f1, "label_name").join(base, "label_name")
            .select("label_name", (F.col("last") < F.col("first")).alias("loss_falls"), better.alias("beats_constant")))


@register("fitted_threshold_sweep", Q.q_fitted_threshold_sweep())
def fitted_threshold_sweep(spark, sf):
    """M5 over fitted scores: fit, score, sweep 26 thresholds, mean F1 over the epochs,
    best threshold per label -- with a recount at the best one."""
    run, features = _minibatch_run(spark, sf, "tuned")
    scored = cut_lineage(_scored(run, features, ("train", "val")), "scored")
    grid = linspace(0.45, 0.70, 26)
    sweep = S.threshold_sweep(scored, ["label_name", "epoch"], grid)
    mean = cut_lineage(S.mean_over(sweep, ["label_name", "threshold"], "f1", "mean_f1"), "sweep")
    best = S.best_threshold(mean, ["label_name"])
    again = scored.join(best.select("label_name", "best_threshold"), "label_name").withColumn(
        "pred", (F.col("p") >= F.col("best_threshold")).cast("int"))
    recount = M.accuracy_f1(M.confusion(again, ["label_name", "epoch"]), ["label_name", "epoch"]).groupBy("label_name").agg(
        F.avg("f1").alias("recounted"))
    points = mean.groupBy("label_name").agg(F.count("*").alias("n_points"), F.max("mean_f1").alias("most"))
    return points.join(recount, "label_name").select(
        "label_name", "n_points", (F.abs(F.col("recounted") - F.col("most")) < 1e-9).alias("recount_equal"))


@register("model_store_rows", Q.q_model_store_rows())
def model_store_rows(spark, sf):
    """K2 per encoder and label: every epoch's model is offered in order by its ROC-AUC on
    the training rows, a strictly better one replaces the current; the current one read
    back scores those rows as the run's best epoch did."""
    store, out = ModelStore(spark, fresh_dir(spark, "models")), None
    for encoder in D.ENCODERS:
        run, features = _minibatch_run(spark, sf, encoder)
        scored = cut_lineage(_scored(run, features, ("train",)), "scored")
        auc = {(r["label_name"], r["epoch"]): r["roc_auc"] for r in M.roc_auc(scored, ["label_name", "epoch"]).collect()}
        for e in range(1, EPOCHS + 1):
            store.publish({(encoder, name): (auc.get((name, e)) or 0.0, e, run.weights[e - 1][:, i])
                           for i, name in enumerate(D.LABEL_NAMES)})
        loaded = MB.Run([np.stack([store.load(encoder, name) for name in D.LABEL_NAMES], axis=1)])
        again = _scored(loaded, features, ("train",)).select("doc_id", "label_name", F.col("p").alias("p2"))
        current = store.current().filter(F.col("encoder") == encoder).select("label_name", "metric", F.col("epoch").alias("best"))
        most = spark.createDataFrame([(n, max((auc.get((n, e)) or 0.0) for e in range(1, EPOCHS + 1))) for n in D.LABEL_NAMES],
                                     "label_name string, most double")
        kept = scored.join(current, "label_name").filter(F.col("epoch") == F.col("best")).join(again, ["doc_id", "label_name"])
        part = kept.groupBy("label_name").agg(F.count("*").alias("n_rows"), F.count_if(F.col("p") == F.col("p2")).alias("n_equal"),
                                              F.max("metric").alias("metric")).join(most, "label_name")
        part = part.select(F.lit(encoder).alias("encoder"), "label_name", "n_rows", "n_equal",
                           (F.col("metric") == F.col("most")).alias("best_kept"))
        out = part if out is None else out.unionByName(part)
    return out

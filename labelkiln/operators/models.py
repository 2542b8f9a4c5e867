"""Classifier heads and per-label model fitting.

Heads over a stored embedding column are row-local expressions (no shuffle).
Weights of the fixed heads follow one rule, W[j][i] = sin(j * d + i + 1),
b = 0, so any engine can rebuild them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F

from labelkiln.functions.columns import dense_layer, relu, sigmoid

EMBED_DIM = 64
HIDDEN = 64
#: Rows pooled together: their sums stay in the cache.
POOLED = 1024


def rule_weights(rows: int, cols: int) -> list[list[float]]:
    return [[math.sin(j * cols + i + 1) for i in range(cols)] for j in range(rows)]


def dense_head(x: Column, dim: int = EMBED_DIM, hidden: int = HIDDEN) -> Column:
    """Probability of the dense head: sigmoid(W2 . sigmoid(W1 . x)), W1 hidden x dim,
    W2 1 x hidden (both by the sine rule, no bias)."""
    h = dense_layer(x, rule_weights(hidden, dim))
    h = F.transform(h, lambda v: sigmoid(v))
    out = dense_layer(h, rule_weights(1, hidden))
    return sigmoid(F.get(out, 0))


def two_class_head(x: Column, dim: int = EMBED_DIM) -> Column:
    """Raw 2-class scores relu(W . x), W 2 x dim by the sine rule."""
    z = dense_layer(x, rule_weights(2, dim))
    return F.transform(z, lambda v: relu(v))


def dense_head_udf(dim: int = EMBED_DIM, hidden: int = HIDDEN):
    """Arrow UDF version of ``dense_head`` for wide embeddings: one matrix
    product per Arrow batch instead of per-row lambdas. The weights are a
    parameter-sized constant shipped with the function."""
    w1 = np.array(rule_weights(hidden, dim))
    w2 = np.array(rule_weights(1, hidden))

    @F.pandas_udf("double")
    def head(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series([], dtype="float64")
        x = np.stack(v.to_numpy()).astype(np.float64)
        h = 1.0 / (1.0 + np.exp(-(x @ w1.T)))
        return pd.Series(1.0 / (1.0 + np.exp(-(h @ w2.T)[:, 0])))

    return head


def token_vectors(vectors, n_ids: int, missing: str = "fail", max_cells: int = 1 << 28) -> np.ndarray:
    """Dense matrix of the vectors of token ids 0..n_ids-1 (rows of ``vectors`` =
    ``vec_id, embedding``), as wide as the vectors are. Ids without a vector are an
    error, or zeros with ``missing='zero'``; so are vectors of unequal width. Only
    ids a tokenizer can emit are kept, so the size is bounded by the vocabulary."""
    rows = {r["vec_id"]: np.asarray(r["embedding"], dtype=np.float32) for r in
            vectors.filter(F.col("vec_id") < n_ids).select("vec_id", "embedding").collect()}
    widths = {len(v) for v in rows.values()}
    if len(widths) != 1:
        raise ValueError(f"token vectors of widths {sorted(widths)}")
    dim = widths.pop()
    if n_ids * dim > max_cells:
        raise ValueError(f"token vector table {n_ids} x {dim} exceeds {max_cells} cells")
    lost = [i for i in range(n_ids) if i not in rows]
    if lost and missing != "zero":
        raise ValueError(f"{len(lost)} of {n_ids} token ids have no vector, the first is {lost[0]}")
    m = np.zeros((n_ids, dim))
    for i, v in rows.items():
        m[i] = v
    return m


def mean_pool(features, key_cols, vectors, n_ids: int, divisor: str = "pad", pad_token: int = 0,
              missing: str = "fail", ids_col: str = "input_ids"):
    """Sum of the token vectors over all positions of ``ids_col``, divided by
    the number of padding ids ('pad', at least 1) or of real ids ('tokens').

    Row-local: one Arrow batch is an (n x L) id matrix; the vectors are looked
    up position by position from a broadcast, vocabulary-bounded matrix -- no
    explode, no shuffle."""
    if divisor not in ("pad", "tokens"):
        raise ValueError(divisor)
    spark = features.sparkSession
    matrix = token_vectors(vectors, n_ids, missing)
    dim = matrix.shape[1]
    bc = spark.sparkContext.broadcast(matrix)
    by_pad = divisor == "pad"

    def pool(ids: pa.Array) -> pa.Array:
        m = bc.value
        widths = np.unique(ids.value_lengths().to_numpy(zero_copy_only=False))
        if len(widths) > 1:
            raise ValueError(f"{ids_col} of lengths {widths[:3].tolist()}")
        x = ids.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        out = np.zeros((len(ids), m.shape[1]))
        for lo in range(0, len(ids), POOLED):
            some, total = x[lo : lo + POOLED], out[lo : lo + POOLED]
            inside = some < m.shape[0]
            whole = inside.all(axis=0)
            for pos in range(x.shape[1]):
                if whole[pos]:
                    total += m[some[:, pos]]
                else:
                    total[inside[:, pos]] += m[some[inside[:, pos], pos]]
            n = ((some == pad_token) if by_pad else (some != pad_token)).sum(axis=1)
            total /= np.maximum(n, 1)[:, None]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * m.shape[1]), pa.array(out.ravel()))

    pool = F.arrow_udf(pool, "array<double>")
    return features.select(*key_cols, pool(F.col(ids_col)).alias("pooled"))


def mean_of_sums(pooled, key_cols, n_col: str, vec_col: str = "pooled"):
    """One vector per key from windows that were each divided by their own ``n_col`` (at
    least 1): the sums of all windows over the sum of ``n_col`` (at least 1)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = pooled.select(*key_cols, n_col, array_to_vector(F.col(vec_col)).alias("_v"),
                      F.greatest(F.col(n_col), F.lit(1)).cast("double").alias("_by"))
    total = v.groupBy(*key_cols).agg(Summarizer.sum(F.col("_v"), F.col("_by")).alias("_s"), F.sum(n_col).alias("_n"))
    by = F.greatest(F.col("_n"), F.lit(1))
    return total.select(*key_cols, F.transform(vector_to_array("_s"), lambda x: x / by).alias(vec_col))


# --------------------------------------------------------------- fitting --
def text_feature_pipeline(text_col: str, num_features: int = 4096):
    """words (same split as the tokenizer) -> hashed term counts -> IDF.
    The word step is a SQL transformer, so a saved model carries it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, IDF, SQLTransformer

    stmt = (f"SELECT *, filter(split(lower({text_col}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w != '') AS _words "
            "FROM __THIS__")
    return Pipeline(stages=[SQLTransformer(statement=stmt),
                            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features),
                            IDF(inputCol="_tf", outputCol="features")])


def fit_per_label(train_feats, feature_model, label_names, max_iter: int = 5, weight_col: str | None = "weight",
                  reg: float = 0.0):
    """One binary classifier per label on featurized rows (independent fits).
    Returns {label: LogisticRegressionModel}, {label: PipelineModel with the
    feature stages, for saving} and {label: objective history}."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression

    heads, pipes, losses = {}, {}, {}
    for name in label_names:
        lr = LogisticRegression(maxIter=max_iter, regParam=reg, standardization=False,
                                **({"weightCol": weight_col} if weight_col else {}))
        m = lr.fit(train_feats.filter(F.col("label_name") == name))
        heads[name] = m
        pipes[name] = PipelineModel(stages=[*feature_model.stages, m])
        losses[name] = list(m.summary.objectiveHistory)
    return heads, pipes, losses


def positive_probability(prob_col: str = "probability"):
    from pyspark.ml.functions import vector_to_array
    return F.get(vector_to_array(F.col(prob_col)), 1)


def score_per_label(heads: dict, feats, keep_cols):
    """Scored rows ``keep_cols..., label_name, y, p`` from each label's model
    (``feats`` already featurized; a full pipeline model also accepts raw rows)."""
    out = None
    for name, m in heads.items():
        part = m.transform(feats.filter(F.col("label_name") == name)).select(
            *keep_cols, "label_name", F.col("label").cast("int").alias("y"), positive_probability().alias("p"))
        out = part if out is None else out.unionByName(part)
    return out


def mean_over_windows(pooled, key_cols, vec_col: str = "pooled"):
    """One vector per key: the mean of its windows' vectors."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = pooled.select(*key_cols, array_to_vector(F.col(vec_col)).alias("_v"))
    return v.groupBy(*key_cols).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(
        *key_cols, vector_to_array("_m").alias(vec_col))


def fit_pooled_classifier(train, vec_col: str = "pooled", max_iter: int = 5, weight_col: str | None = None):
    """2-class classifier on pooled sequence vectors (multinomial logistic
    regression over the pooled vector; the decision is the arg-max class)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = train.select(array_to_vector(F.col(vec_col)).alias("features"), F.col("y").cast("double").alias("label"),
                        *([weight_col] if weight_col else []))
    lr = LogisticRegression(family="multinomial", maxIter=max_iter,
                            **({"weightCol": weight_col} if weight_col else {}))
    return lr.fit(data)


def argmax_scores(model, rows, vec_col: str = "pooled", keep_cols=()):
    """Raw 2-class scores and the first arg-max class."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from labelkiln.functions.columns import argmax_index

    t = model.transform(rows.withColumn("features", array_to_vector(F.col(vec_col))))
    z = vector_to_array(F.col("rawPrediction"))
    return t.select(*keep_cols, "y", argmax_index(z).alias("pred"), z.alias("z"))


def fit_dense_head(train, vec_col: str = "pooled", hidden: int = HIDDEN, dim: int = EMBED_DIM,
                   max_iter: int = 50, seed: int = 1234):
    """Dense head over a vector column: hidden layer of sigmoid units, 2-way
    softmax output (equivalent to one sigmoid output). The classifier has no
    row weights, so ``train`` should already be class-balanced (e.g. the
    weighted resample)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector

    data = train.select(array_to_vector(F.col(vec_col)).alias("features"), F.col("y").cast("double").alias("label"))
    mlp = MultilayerPerceptronClassifier(layers=[dim, hidden, 2], maxIter=max_iter, seed=seed, blockSize=128)
    return mlp.fit(data)

"""Inputs derived from the given tables.

The comment table, its splits and the scored rows are all computed from
``labels`` and ``documents`` by value (md5 of keys), so they are identical on any
partitioning and reproducible by the SQL oracle. Mapping (fixed rules):

* threat = toxic=1 and quality=0; insult = 1 - quality; toxic = toxic;
  IsAbuse = toxic=1 or quality=0
* split: h = hash52('split:' || doc_id); h % 10 in 0..7 train, 8 val, 9 test
* score p of (encoder, label, epoch, doc): hash_byte_score(encoder:label:epoch:doc_id)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelkiln.functions.columns import hash52, hash_byte_score

# The four label names in the order of the label vector.
LABEL_NAMES = ("threat", "insult", "toxic", "IsAbuse")
# The two encoders compared, and the number of epochs.
ENCODERS = ("base", "tuned")
NUM_EPOCHS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def token_vector_table(spark: SparkSession, sf_dir: str, n_ids: int) -> DataFrame:
    """A vector for every token id: the embeddings are used round and round."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_v"), "embedding")
    ids = spark.range(n_ids).select(F.col("id").alias("vec_id"), (F.col("id") % F.lit(e.count())).alias("_v"))
    return ids.join(e, "_v").select("vec_id", "embedding")


def split_of(key: Column, tag: str = "split:") -> Column:
    h = hash52(tag, key) % 10
    return F.when(h < 8, "train").when(h == 8, "val").otherwise("test")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, comment_text, threat, insult, toxic, IsAbuse, split."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "text")
    tox, q = F.col("toxic"), F.col("quality")
    return lab.join(doc, "doc_id").select(
        "doc_id",
        F.col("text").alias("comment_text"),
        ((tox == 1) & (q == 0)).cast("int").alias("threat"),
        (F.lit(1) - q).cast("int").alias("insult"),
        tox.cast("int").alias("toxic"),
        ((tox == 1) | (q == 0)).cast("int").alias("IsAbuse"),
        split_of(F.col("doc_id")).alias("split"),
    )


def labelled(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Long form: one row per (doc, label): doc_id, split, label_name, y [, text]."""
    c = comments(spark, sf_dir)
    ids = ["doc_id", "split"] + (["comment_text"] if with_text else [])
    return c.unpivot(ids, list(LABEL_NAMES), "label_name", "y")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo model output for every labelled row, encoder and epoch:
    doc_id, split, label_name, y, encoder, epoch, p."""
    base = labelled(spark, sf_dir)
    rows = (base
            .withColumn("encoder", F.explode(F.array(*[F.lit(e) for e in ENCODERS])))
            .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(NUM_EPOCHS)))))
    p = hash_byte_score(F.col("encoder"), ":", F.col("label_name"), ":", F.col("epoch"), ":", F.col("doc_id"))
    return rows.withColumn("p", p)


# Number of classes of the prediction fixture per task.
TASK_CLASSES = {"cola": 2, "sst-2": 2, "mrpc": 2, "qqp": 2, "mnli": 3, "mnli-mm": 3, "qnli": 2,
                "rte": 2, "wnli": 2, "hans": 2, "boolq": 2, "abuse": 2, "xnli": 3}


def task_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task, id, pred, label) for every task: classification tasks from
    ``labels`` (label = toxic for 2 classes, doc_id % 3 for 3 classes, the
    prediction right for hash byte < 200 and shifted otherwise); sts-b from
    ``conversations`` (label = turn % 6, pred = 0.8 * label + noise)."""
    lab = table(spark, sf_dir, "labels")
    rows = lab.select("doc_id", "toxic").withColumn(
        "task", F.explode(F.array(*[F.lit(t) for t in TASK_CLASSES])))
    k = F.when(F.col("task").isin([t for t, n in TASK_CLASSES.items() if n == 3]), 3).otherwise(2)
    label = F.when(k == 2, F.col("toxic")).otherwise(F.col("doc_id") % 3).cast("int")
    h = F.conv(F.substring(F.md5(F.concat(F.col("task"), F.lit(":"), F.col("doc_id").cast("string"))), 1, 2), 16, 10).cast("int")
    pred = F.when(h < 200, label).otherwise((label + 1) % k)
    cls_rows = rows.select("task", F.col("doc_id").alias("id"), pred.cast("double").alias("pred"),
                           label.cast("double").alias("label"))
    return cls_rows.unionByName(regression_predictions(spark, sf_dir))


def regression_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sts-b rows of ``task_predictions``."""
    conv = table(spark, sf_dir, "conversations")
    lab_r = (F.col("turn") % 6).cast("double")
    return conv.select(
        F.lit("sts-b").alias("task"),
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("id"),
        (lab_r * F.lit(0.8) + hash_byte_score("stsb:", F.col("conv_id"), ":", F.col("turn"))).alias("pred"),
        lab_r.alias("label"))

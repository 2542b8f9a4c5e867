"""Registered reader, feature and head queries (see catalog.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.functions.columns import argmax_index, rounded
from labelkiln.operators import features as FE
from labelkiln.operators import models as MO
from labelkiln.plans import derived as D
from labelkiln.plans import sql_text as X
from labelkiln.plans.catalog import register
from labelkiln.session import fresh_dir, rebalance, spread
from labelkiln.sources import fixtures as FX
from labelkiln.sources import readers as R
from labelkiln.sources.tasks import TASKS

MAX_LEN = 128


# ---------------------------------------------------------------- readers --
def _reader(task: str):
    def run(spark, sf):
        d = FX.write_task_dir(spark, sf, task)
        return R.read_task_all(spark, TASKS[task], d)
    run.__name__ = f"read_{task.replace('-', '_')}"
    return run


for _t in TASKS:
    register(f"read_{_t.replace('-', '_')}", X.q_read_task(_t))(_reader(_t))


@register("named_record_examples", X.q_named_record_examples())
def named_record_examples(spark, sf):
    out = None
    for task in X.NAMED_TASKS:
        path = FX.write_named_records(spark, sf, task)
        ex = R.named_record_examples(spark.read.parquet(path), TASKS[task]).withColumn("task", F.lit(task))
        out = ex if out is None else out.unionByName(ex)
    return out


@register("split_union", X.q_split_union())
def split_union(spark, sf):
    return R.read_comment_splits(spark, FX.write_comment_splits(spark, sf))


def _all_examples(spark, sf):
    out = None
    for task, spec in TASKS.items():
        ex = R.read_task_all(spark, spec, FX.write_task_dir(spark, sf, task))
        ex = FE.label_ids(ex, spec.labels, spec.mode, on_unseen="quarantine").withColumn("task", F.lit(task))
        out = ex if out is None else out.unionByName(ex)
    return out


@register("label_ids", X.q_label_ids())
def label_ids(spark, sf):
    return _all_examples(spark, sf).select("task", "guid", "label", "label_id", "label_value")


@register("label_quarantine", X.q_label_ids(quarantine_only=True))
def label_quarantine(spark, sf):
    ex = _all_examples(spark, sf)
    return ex.filter(F.col("label_id").isNull() & (F.col("task") != "sts-b")).select("task", "guid", "label")


# --------------------------------------------------------------- features --
def _docs(spark, sf):
    return spread(D.table(spark, sf, "documents"))


_VOCABS: dict[tuple[str, str], FE.Vocab] = {}


def _vocab(spark, sf):
    """The corpus vocabulary, built once per session and corpus (like loading a
    tokenizer once) and kept as a bounded, size-checked local table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _VOCABS:
        _VOCABS[key] = FE.Vocab.of(FE.build_vocab(_docs(spark, sf), "text"))
    return _VOCABS[key]


@register("tokens", X.q_tokens())
def tokens(spark, sf):
    w = FE.words(F.col("text"))
    return _docs(spark, sf).select("doc_id", w.alias("words"), F.size(w).alias("n_words"))


@register("vocab_ids", X.q_vocab_ids())
def vocab_ids(spark, sf):
    return FE.build_vocab(_docs(spark, sf), "text")


@register("wordpiece_words", X.q_wordpiece_words())
def wordpiece_words(spark, sf):
    dw = _docs(spark, sf).select(F.explode(FE.words(F.col("text"))).alias("word")).distinct()
    return FE.wordpiece_ids(rebalance(dw), _vocab(spark, sf))


def _single(spark, sf, **kw):
    return FE.encode(_docs(spark, sf).select("doc_id", "text"), ["doc_id"], "text", None, _vocab(spark, sf),
                     MAX_LEN, **kw)


def _pair(spark, sf, **kw):
    p = FX.pair_rows(spark, sf)
    return FE.encode(p, ["pair_id"], "text_a", "text_b", _vocab(spark, sf), MAX_LEN, **kw)


@register("encode_single_128", X.q_encode_single(MAX_LEN))
def encode_single_128(spark, sf):
    return _single(spark, sf)


@register("inverted_mask", X.q_encode_single(MAX_LEN, mask_zero=False))
def inverted_mask(spark, sf):
    return _single(spark, sf, mask_padding_with_zero=False)


@register("encode_pair", X.q_encode_pair(MAX_LEN))
def encode_pair(spark, sf):
    return _pair(spark, sf)


@register("encode_pad_left", X.q_encode_pair(MAX_LEN, left=True, pad_seg=4))
def encode_pad_left(spark, sf):
    return _pair(spark, sf, pad_on_left=True, pad_token_segment_id=4)


@register("feature_length_check", X.q_feature_length_check(MAX_LEN))
def feature_length_check(spark, sf):
    f = _single(spark, sf)
    return f.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(~FE.length_check(f, MAX_LEN)).alias("n_bad"))


@register("pad_count", X.q_pad_count(MAX_LEN))
def pad_count(spark, sf):
    return _single(spark, sf).select("doc_id", FE.pad_count(F.col("input_ids")).alias("pad_count"))


@register("preview_first_5", X.q_preview_first_5(MAX_LEN))
def preview_first_5(spark, sf):
    spec = TASKS["mrpc"]
    ex = R.read_task(spark, spec, FX.write_task_dir(spark, sf, "mrpc"), "train")
    # the preview is a top-5 by design; five rows are taken once to the driver
    # (as a log preview is) so the branches below do not recompute the top-k
    first = spark.createDataFrame(ex.orderBy("row_idx").limit(5).collect(), ex.schema)
    feats = FE.encode(first, ["guid"], "text_a", "text_b", _vocab(spark, sf), MAX_LEN)
    lab = FE.label_ids(first, spec.labels, spec.mode).select("guid", "row_idx", "label_id")
    return FE.assert_lengths(feats, MAX_LEN).join(lab, "guid")


def pooled_documents(spark, sf, divisor, wanted=None):
    """One vector per document over its whole text (the mean of its windows); where the
    vectors are joined with some documents only, ``wanted`` (with doc_id) has these."""
    v = _vocab(spark, sf)
    docs = _docs(spark, sf).select("doc_id", "text")
    if wanted is not None:
        docs = docs.join(wanted.select("doc_id"), "doc_id", "left_semi")
    feats = FE.encode(docs, ["doc_id"], "text", None, v, MAX_LEN, overflow="windows")
    pooled = MO.mean_pool(feats, ["doc_id"], D.token_vector_table(spark, sf, len(v.map)), len(v.map), divisor)
    return MO.mean_over_windows(pooled, ["doc_id"])


def _pooled(spark, sf, divisor):
    """Sum of a document's token vectors over all its windows, by the pads or the real
    tokens of all of them."""
    v = _vocab(spark, sf)
    feats = FE.encode(_docs(spark, sf).select("doc_id", "text"), ["doc_id"], "text", None, v, MAX_LEN, overflow="windows")
    n = F.size(F.filter("input_ids", lambda x: x == 0 if divisor == "pad" else x != 0))
    sums = MO.mean_pool(feats.withColumn("n", n), ["doc_id", "n"], D.token_vector_table(spark, sf, len(v.map)), len(v.map), divisor)
    return rounded(MO.mean_of_sums(sums, ["doc_id"], "n"))


@register("mean_pool_pad_divisor", X.q_mean_pool("pad", MAX_LEN))
def mean_pool_pad_divisor(spark, sf):
    return _pooled(spark, sf, "pad")


@register("mean_pool_token_divisor", X.q_mean_pool("tokens", MAX_LEN))
def mean_pool_token_divisor(spark, sf):
    return _pooled(spark, sf, "tokens")


@register("mean_pool_windows_pad_divisor", X.q_mean_pool_windows("pad", MAX_LEN))
def mean_pool_windows_pad_divisor(spark, sf):
    return rounded(pooled_documents(spark, sf, "pad"))


@register("mean_pool_windows_token_divisor", X.q_mean_pool_windows("tokens", MAX_LEN))
def mean_pool_windows_token_divisor(spark, sf):
    return rounded(pooled_documents(spark, sf, "tokens"))


# ------------------------------------------------------------------ heads --
@register("dense_head_scores", X.q_dense_head_scores())
def dense_head_scores(spark, sf):
    e = D.table(spark, sf, "embeddings")
    return rounded(e.select("vec_id", "label", MO.dense_head_udf()(F.col("embedding")).alias("p")))


@register("argmax_class", X.q_argmax_class())
def argmax_class(spark, sf):
    e = D.table(spark, sf, "embeddings").select("vec_id", MO.two_class_head(F.col("embedding")).alias("z"))
    return rounded(e.select("vec_id", argmax_index("z").alias("pred_class"), F.get("z", 0).alias("z0"),
                            F.get("z", 1).alias("z1")))


# ------------------------------------------------------------------ sinks --
@register("feature_sink_round_trip", X.q_feature_sink(MAX_LEN))
def feature_sink_round_trip(spark, sf):
    """K1: features (int arrays) and label written as Parquet and read back; a document
    without a label has a null one."""
    path = fresh_dir(spark, "features") + "/features"
    label = D.table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("bigint").alias("label"))
    _single(spark, sf).join(label, "doc_id", "left").write.parquet(path)
    return spark.read.parquet(path)


@register("stream_dense_head_scores", X.q_stream_scores())
def stream_dense_head_scores(spark, sf):
    """The dense head + threshold run as a Structured Streaming job over the
    embeddings files (file source -> Parquet sink), then read back. The table may be
    one file or a folder of part files."""
    from labelkiln.streaming import stream_scores
    root = fresh_dir(spark, "stream")
    # a pattern: a file source takes no path of a single file
    q = stream_scores(spark, f"{sf.rstrip('/')}/embeddings.parque[t]", f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return rounded(out.select("vec_id", "label", "p", "pred"))


# ------------------------------------------------- examples -> features --
def _task_features(task: str):
    def run(spark, sf):
        spec = TASKS[task]
        ex = R.read_task_all(spark, spec, FX.write_task_dir(spark, sf, task))
        return FE.convert_examples_to_features(ex, spec.labels, spec.mode, _vocab(spark, sf), MAX_LEN,
                                               pair=spec.text_b is not None)
    run.__name__ = f"features_{task.replace('-', '_')}"
    return run


for _t in ("mrpc", "sts-b", "cola"):
    register(f"features_{_t.replace('-', '_')}", X.q_task_features(_t, MAX_LEN))(_task_features(_t))


@register("features_repeated_guid", X.q_features_repeated_guid(MAX_LEN))
def features_repeated_guid(spark, sf):
    """E1 with guids that repeat (and are null for some rows): one feature row per
    example, told apart by its row index."""
    p = FX.pair_rows(spark, sf)
    guid = F.when(F.col("pair_id") % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("train-"), (F.col("pair_id") % 3).cast("string")))
    ex = p.select(F.lit("train").alias("set_type"), F.col("pair_id").alias("row_idx"), guid.alias("guid"), "text_a", "text_b",
                  (F.col("conv_id") % 2).cast("string").alias("label"))
    return FE.convert_examples_to_features(ex, ("0", "1"), "classification", _vocab(spark, sf), MAX_LEN, pair=True)


@register("encode_windows_128", X.q_encode_windows(MAX_LEN))
def encode_windows_128(spark, sf):
    """F1 over whole texts: one row per window of 126 pieces."""
    return _single(spark, sf, overflow="windows")


@register("example_counts", X.q_example_counts())
def example_counts(spark, sf):
    """A19: number of examples per task and set, read through the task files."""
    out = None
    for task, spec in TASKS.items():
        ex = R.read_task_all(spark, spec, FX.write_task_dir(spark, sf, task)).withColumn("task", F.lit(task))
        part = ex.groupBy("task", "set_type").agg(F.count(F.lit(1)).alias("n_examples"))
        out = part if out is None else out.unionByName(part)
    return out

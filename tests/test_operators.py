"""Edge cases and brute-force checks of the operators on hand-made tables."""

import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelkiln.operators import features as FE
from labelkiln.operators import metrics as M
from labelkiln.operators import ordering as O
from labelkiln.operators import sampling as SA
from labelkiln.operators import selection as S


def _scored(spark, rows):
    return spark.createDataFrame(rows, "g string, y int, p double")


def _auc_brute(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y != 1]
    if not pos or not neg:
        return None
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_matches_brute_force_with_ties(spark):
    rnd = random.Random(7)
    rows = [("a", rnd.randint(0, 1), rnd.randint(0, 20) / 20) for _ in range(400)]
    rows += [("b", 1, 0.5), ("b", 0, 0.5), ("b", 1, 0.7), ("b", 0, 0.1)]
    rows += [("c", 1, 0.3), ("c", 1, 0.9)]  # one class only
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(_scored(spark, rows), ["g"], buckets=7).collect()}
    for g in "abc":
        exp = _auc_brute([(y, p) for gg, y, p in rows if gg == g])
        assert (got[g] is None and exp is None) or abs(got[g] - exp) < 1e-12


def test_auc_agrees_with_mllib_exact(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(3)
    rows = [("a", rnd.randint(0, 1), rnd.random()) for _ in range(500)]
    df = _scored(spark, rows)
    ours = M.roc_auc(df, ["g"]).collect()[0]["roc_auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="yd", numBins=0)
    ref = ev.evaluate(df.withColumn("yd", F.col("y").cast("double")))
    assert abs(ours - ref) < 1e-12


def test_confusion_edges(spark):
    rows = [("allpos", 1, 0.9), ("allpos", 1, 0.2), ("allneg", 0, 0.1), ("allneg", 0, 0.48),
            ("tie", 1, 0.48), ("tie", 0, 0.47999)]
    df = _scored(spark, rows).withColumn("pred", M.predict("p", 0.48))
    conf = {r["g"]: r for r in M.confusion(df, ["g"]).collect()}
    assert (conf["tie"]["tp"], conf["tie"]["tn"]) == (1, 1)  # p >= t is inclusive
    af = {r["g"]: r for r in M.accuracy_f1(M.confusion(df, ["g"]), ["g"]).collect()}
    assert af["allneg"]["f1"] == 0.0 and af["allneg"]["acc"] == 0.5
    mcc = {r["g"]: r["m"] for r in M.confusion(df, ["g"]).select("g", M.mcc_expr().alias("m")).collect()}
    assert mcc["allpos"] == 0.0  # undefined -> 0


def test_empty_input_gives_no_groups(spark):
    df = _scored(spark, [("a", 1, 0.5)]).filter("false")
    assert M.roc_auc(df, ["g"]).count() == 0
    assert M.confusion(df.withColumn("pred", M.predict()), ["g"]).count() == 0


def test_pearson_spearman_against_pandas(spark):
    rnd = random.Random(11)
    rows = [("t", float(rnd.randint(0, 5)), float(rnd.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(rows, "task string, pred double, label double")
    got = M.pearson_and_spearman(df, ["task"], buckets=5).collect()[0]
    pdf = pd.DataFrame(rows, columns=["task", "pred", "label"])
    assert abs(got["pearson"] - pdf["pred"].corr(pdf["label"])) < 1e-9
    ranks = pdf[["pred", "label"]].rank(method="average")
    assert abs(got["spearmanr"] - ranks["pred"].corr(ranks["label"])) < 1e-9
    const = spark.createDataFrame([("t", 1.0, 2.0), ("t", 1.0, 3.0)], "task string, pred double, label double")
    r = M.pearson_and_spearman(const, ["task"]).collect()[0]
    assert r["pearson"] is None and r["spearmanr"] is None


def test_task_metrics_unknown_task_raises(spark):
    with pytest.raises(KeyError):
        M.metrics_for("nope")
    df = spark.createDataFrame([("nope", 1.0, 1.0)], "task string, pred double, label double")
    with pytest.raises(Exception, match="KeyError"):
        M.task_metrics(df).collect()


def test_alignment_check_counts_missing(spark):
    p = spark.createDataFrame([(1, "a"), (2, "a")], "id int, g string")
    lab = spark.createDataFrame([(2, "a"), (3, "a")], "id int, g string")
    r = M.alignment_check(p, lab, ["id"], ["g"]).collect()[0]
    assert (r["n_keys"], r["n_missing_label"], r["n_missing_pred"]) == (3, 1, 1)


def test_prefix_and_rank_are_partition_invariant(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 2)) for i in range(2000)]
    base = spark.createDataFrame(rows, "id long, g int").withColumn("k", O.order_key(42, "id"))
    results = []
    for n in (1, 4, 13):
        df = base.repartition(n)
        r = O.rank_by_key(df, ["g"], ["k", "id"], "ri", buckets=9)
        results.append(sorted((x["id"], x["ri"]) for x in r.collect()))
    assert results[0] == results[1] == results[2]
    # positions are a permutation 0..n-1 per group, ordered by key
    pdf = pd.DataFrame([r.asDict() for r in base.collect()])
    got = dict(results[0])
    for g, part in pdf.groupby("g"):
        order = part.sort_values(["k", "id"])["id"].tolist()
        assert [got[i] for i in order] == list(range(len(order)))


def test_rank_by_key_limit_keeps_first_n(spark):
    base = spark.range(1000).withColumn("g", (F.col("id") % 2).cast("int")).withColumn("k", O.order_key(1, "id"))
    full = {r["id"]: r["ri"] for r in O.rank_by_key(base, ["g"], ["k", "id"], "ri", buckets=16).collect()}
    lim = F.when(F.col("g") == 0, F.lit(7)).otherwise(F.lit(300))
    cut = O.rank_by_key(base, ["g"], ["k", "id"], "ri", buckets=16, limit=lim).collect()
    exp = {i: r for i, r in full.items() if r < (7 if i % 2 == 0 else 300)}
    assert {r["id"]: r["ri"] for r in cut} == exp


def test_file_row_index_across_blocks(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    (spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "k long, l string")
     .repartitionByRange(3, "k").sortWithinPartitions("k").select("l").write.text(path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = O.with_file_row_index(spark.read.text(path))
        assert df.rdd.getNumPartitions() > 3
        got = sorted((r["row_idx"], r["value"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines))


def test_weighted_resample_is_exact_and_balanced(spark):
    rows = [(i, "lab", 1 if i < 30 else 0, i) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, label_name string, y int, row_idx long")
    r = SA.weighted_resample(df, "doc_id", "row_idx", 42)
    out = r.collect()
    assert len(out) == 600 and sorted(x["draw"] for x in out) == list(range(600))
    pos = sum(x["y"] for x in out)
    assert 240 < pos < 360  # each class drawn with probability 1/2
    again = SA.weighted_resample(df.repartition(7), "doc_id", "row_idx", 42).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    only = spark.createDataFrame([(i, "lab", 0, i) for i in range(20)], "doc_id long, label_name string, y int, row_idx long")
    assert {x["y"] for x in SA.weighted_resample(only, "doc_id", "row_idx").collect()} == {0}


def test_truncate_pair_closed_form_matches_loop(spark):
    def loop(na, nb, budget):
        while na + nb > budget:
            if na > nb:
                na -= 1
            else:
                nb -= 1
        return na, nb
    cases = [(a, b, t) for a, b, t in itertools.product(range(14), range(14), range(1, 12))]
    df = spark.createDataFrame(cases, "na int, nb int, t int")
    outs = []
    for t in range(1, 12):
        ka, kb = FE.truncate_pair(F.col("na"), F.col("nb"), t)
        outs += df.filter(F.col("t") == t).select("na", "nb", "t", ka.alias("ka"), kb.alias("kb")).collect()
    for r in outs:
        assert (r["ka"], r["kb"]) == loop(r["na"], r["nb"], r["t"]), r


def test_greedy_pieces():
    v = {"un": 4, "##aff": 5, "##able": 6, "a": 7, "##b": 8}
    assert FE.greedy_pieces("unaffable", v) == [4, 5, 6]
    assert FE.greedy_pieces("ab", v) == [7, 8]
    assert FE.greedy_pieces("abz", v) == [1]
    assert FE.greedy_pieces("a" * 101, v) == [1]


def test_encode_layout_and_padding(spark):
    vocab = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), ("a", 4), ("b", 5),
                                   ("##b", 6), ("c", 7)], "piece string, piece_id int")
    df = spark.createDataFrame([(1, "a b ab", "c c c c"), (2, "", None)], "k int, x string, y string")
    single = {r["k"]: r for r in FE.encode(df, ["k"], "x", None, vocab, 8).collect()}
    assert single[1]["input_ids"] == [2, 4, 5, 4, 6, 3, 0, 0]
    assert single[1]["attention_mask"] == [1, 1, 1, 1, 1, 1, 0, 0]
    assert single[2]["input_ids"] == [2, 3, 0, 0, 0, 0, 0, 0]
    pair = {r["k"]: r for r in FE.encode(df, ["k"], "x", "y", vocab, 8, pad_on_left=True,
                                         pad_token_segment_id=4).collect()}
    # budget 5: a has 4 pieces, b has 4 -> 3 + 2 (ties cut the second text)
    assert pair[1]["input_ids"] == [2, 4, 5, 4, 3, 7, 7, 3]
    assert pair[1]["token_type_ids"] == [0, 0, 0, 0, 0, 1, 1, 1]
    assert pair[2]["input_ids"] == [0, 0, 0, 0, 0, 2, 3, 3]
    assert pair[2]["token_type_ids"] == [4, 4, 4, 4, 4, 0, 0, 1]
    inv = FE.encode(df, ["k"], "x", None, vocab, 8, mask_padding_with_zero=False).filter("k = 1").collect()[0]
    assert inv["attention_mask"] == [0, 0, 0, 0, 0, 0, 1, 1]


def test_label_ids_modes(spark):
    ex = spark.createDataFrame([("a",), ("b",), ("z",)], "label string")
    q = FE.label_ids(ex, ("a", "b"), "classification", "quarantine").collect()
    assert [r["label_id"] for r in q] == [0, 1, None]
    with pytest.raises(Exception, match="unseen label"):
        FE.label_ids(ex, ("a", "b"), "classification", "fail").collect()
    reg = FE.label_ids(spark.createDataFrame([("2.5",)], "label string"), None, "regression").collect()[0]
    assert reg["label_value"] == 2.5 and reg["label_id"] is None
    with pytest.raises(KeyError):
        FE.label_ids(ex, None, "other")


def test_tail_and_history_arrays(spark):
    h = spark.createDataFrame([("a", e, b, float(e * 10 + b)) for e in range(1, 4) for b in range(5)],
                              "g string, epoch int, batch int, loss double")
    t = S.tail(h, ["g"], ["epoch", "batch"], 3).collect()
    assert sorted((r["epoch"], r["batch"]) for r in t) == [(3, 2), (3, 3), (3, 4)]
    arr = S.history_arrays(h.filter("batch = 0"), ["g"], "epoch", "loss").collect()[0]["values"]
    assert arr == [10.0, 20.0, 30.0]


def test_buckets_adapt_to_piled_up_scores(spark):
    # 3000 distinct scores crammed just below 1.0 plus 300 spread ones: fixed
    # width buckets would put 90% of them in one bucket
    rows = [("a", i % 2, 1.0 - 1e-9 * (i + 1)) for i in range(3000)] + \
           [("a", i % 2, i / 300) for i in range(300)]
    df = _scored(spark, rows)
    b = O.value_buckets(df, ["g"], "p", buckets=64, coarse=16)
    biggest = b.groupBy("_lk_b").count().agg(F.max("count")).collect()[0][0]
    assert biggest < 0.1 * len(rows)
    got = M.roc_auc(df, ["g"], buckets=64).collect()[0]["roc_auc"]
    assert abs(got - _auc_brute([(y, p) for _, y, p in rows])) < 1e-12


def test_single_bucket_keeps_every_group(spark):
    df = _scored(spark, [("a", 0, 0.0), ("b", 1, 0.2), ("b", 0, 0.1)])
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, ["g"], buckets=1).collect()}
    assert got == {"a": None, "b": 1.0}


def test_average_rank_matches_pandas(spark):
    rnd = random.Random(2)
    rows = [(g, float(rnd.randint(0, 15))) for g in ("a", "b") for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["v"]): r["rank"] for r in O.average_rank(df, ["g"], "v", buckets=6).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    pdf["r"] = pdf.groupby("g")["v"].rank(method="average")
    for (g, v), r in pdf.groupby(["g", "v"])["r"].first().items():
        assert got[(g, v)] == r




def test_features_keep_rows_with_repeated_and_null_guids_apart(spark):
    from labelkiln.operators import features as FE
    vocab = FE.Vocab(spark, {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "aa": 4, "bb": 5, "cc": 6})
    rows = [("train", 0, "g", "aa bb", "cc", "0"), ("train", 1, "g", "bb", "aa", "1"), ("train", 2, None, "cc", "", "0")]
    ex = spark.createDataFrame(rows, "set_type string, row_idx long, guid string, text_a string, text_b string, label string")
    got = {r["row_idx"]: r["input_ids"] for r in
           FE.convert_examples_to_features(ex, ("0", "1"), "classification", vocab, 8, pair=True).collect()}
    assert got == {0: [2, 4, 5, 3, 6, 3, 0, 0], 1: [2, 5, 3, 4, 3, 0, 0, 0], 2: [2, 6, 3, 3, 0, 0, 0, 0]}


def test_windows_cover_the_whole_text(spark):
    from labelkiln.operators import features as FE
    vocab = FE.Vocab(spark, {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "aa": 4, "bb": 5})
    df = spark.createDataFrame([(1, "aa bb aa bb aa"), (2, None)], "k int, t string")
    got = sorted((r["k"], r["window"], r["input_ids"]) for r in
                 FE.encode(df, ["k"], "t", None, vocab, 4, overflow="windows").collect())
    assert got == [(1, 0, [2, 4, 5, 3]), (1, 1, [2, 4, 5, 3]), (1, 2, [2, 4, 3, 0]), (2, 0, [2, 3, 0, 0])]


def test_unpaired_predictions_fail(spark):
    import pytest
    from labelkiln.operators import metrics as M
    a = spark.createDataFrame([(1, 0.5), (2, 0.6)], "k int, p double")
    b = spark.createDataFrame([(1, 0), (2, 1)], "k int, y int")
    assert M.paired(a, b, ["k"]).count() == 2
    for x, y in ((a, b.limit(1)), (a.limit(1), b)):
        with pytest.raises(Exception, match="differ in length"):
            M.paired(x, y, ["k"]).collect()

"""Cases that went wrong once."""

import numpy as np
import pytest
from llm_data import words
from pyspark.sql import functions as F

from labelkiln.llm import neighbours as N
from labelkiln.llm import resampling as Q
from labelkiln.llm import toxicity as X
from labelkiln.llm.common import lookup
from labelkiln.llm.simhash import keep_one


def test_rows_that_differ_in_the_places_of_their_nulls_are_two(spark):
    a, b = words(1, 40), words(2, 40)
    df = spark.createDataFrame([(1, a, None), (1, None, a), (1, b, None), (1, b, None)], "doc_id long, text string, other string")
    got = [(r["text"], r["other"]) for r in keep_one(df).collect()]
    assert len(got) == 3 and set(got) == {(a, None), (None, a), (b, None)}


@pytest.mark.parametrize("probes,tables", [(1, 4), (2, 16)])
def test_recall_is_reached_with_few_probes(monkeypatch, probes, tables):
    monkeypatch.setattr(N, "MOST_PROBES", probes)
    monkeypatch.setattr(N, "MOST_TABLES", tables)
    x = np.random.default_rng(1).standard_normal((600, 24))
    made, used = N.fit(x, 10**8, 10, 4, 7)
    d = N.distances(x[: N.FIT_QUERIES], x)
    d[np.arange(N.FIT_QUERIES), np.arange(N.FIT_QUERIES)] = np.inf
    near = np.argsort(d, axis=1, kind="stable")[:, :10]
    assert used <= probes and made.n <= tables and N.sample_recall(made, used, x, near) >= N.FIT_RECALL


def test_one_labelled_id_on_many_documents_is_one_sample_row(spark):
    docs = spark.createDataFrame([(1, words(i, 5)) for i in range(300)] + [(2, "x"), (None, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = Q.labelled_sample(docs, labels, "doc_id", "text", "quality", 1)
    assert sorted((r["id"], r["y"]) for r in got.collect()) == [(1, 1), (2, 0)]
    assert X.training_documents(docs, labels, F.lit(True), "doc_id", "text", "toxic").count() == 2


def test_share_and_temperature(spark):
    docs = spark.createDataFrame([(i, words(i, 30)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(100)], "doc_id long, quality int, toxic int")
    for share in (0.0, 0.25, 1.0):
        got = Q.draw(docs, labels, share=share)
        assert got.filter("kept").count() == round(200 * share)
        assert Q.resample(docs, labels, share=share).count() == round(200 * share)
    cold, hot = (({r["doc_id"] for r in Q.draw(docs, labels, share=0.5, temperature=t).filter("kept").collect()}) for t in (1.0, 1e6))
    heavy = {r["doc_id"] for r in Q.draw(docs, labels).orderBy(F.desc("log_weight")).limit(100).collect()}
    assert len(cold & heavy) > len(hot & heavy)  # a hot draw looks less at the weights


def test_lookup_deals_frequent_and_null_keys(spark, tmp_path):
    spark.createDataFrame([(i, "hot" if i % 2 else None if i % 3 else f"k{i}") for i in range(6000)], "i long, k string").write.parquet(
        str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    keyed = spark.createDataFrame([("hot", 1), ("k0", 2), ("unused", 3)], "k string, v int")
    got = lookup(rows, keyed, ["k"], least=64).collect()
    assert len(got) == 6000 and all(r["v"] == {"hot": 1, "k0": 2}.get(r["k"]) for r in got)


def test_kept_columns_called_like_the_outputs(spark):
    import public_tokenizers

    from labelkiln.llm.bpe import Bpe
    df = spark.createDataFrame([(1, "hello there", "x", 5)], "ids long, text string, decoded string, _0 int")
    got = Bpe(spark, public_tokenizers.path("word_bpe_49k.json")).encode_decode(df, ["ids", "decoded", "_0"])
    assert got.columns == ["ids", "decoded", "_0", "_ids", "_decoded"]
    row = got.first()
    assert row["ids"] == 1 and row["decoded"] == "x" and row["_0"] == 5 and "hello" in row["_decoded"] and row["_ids"]

"""Weighted draws against the weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.operators import draws as W


def test_alias_table_holds_the_weights_exactly():
    rng = np.random.default_rng(1)
    for w in (rng.random(50), rng.pareto(0.3, 200), np.array([5.0]), np.array([1e-12, 1.0, 1e12]), np.ones(7)):
        keep, other = W.alias_table(w)
        share = np.bincount(other, 1 - keep, len(w)) + keep
        assert np.allclose(share / len(w), w / w.sum(), atol=1e-12) and (keep >= -1e-12).all() and (keep <= 1 + 1e-12).all()
    got = np.bincount(W.alias_draws(np.array([1.0, 0.0, 3.0]), 100_000, rng), minlength=3)
    assert got[1] == 0 and abs(got[2] - 75_000) < 5 * np.sqrt(100_000 * 0.25 * 0.75)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    for key in (1, 99):
        assert sorted(W.permuted(np.arange(n), n, key).tolist()) == list(range(n))
        # in any order and in parts
        assert W.permuted(np.arange(n)[::-1], n, key).tolist() == W.permuted(np.arange(n), n, key).tolist()[::-1]


def frame(spark):
    rows = [("a", i, float(i % 7)) for i in range(700)] + [("b", i, 1.0) for i in range(300)] + [("b", 1000, 300.0)]
    rows += [("c", 1, 0.0), ("c", 2, None), (None, 5, 2.0), (None, 6, 6.0), ("d", 9, 1.0), ("d", 9, 1.0), ("d", 9, 2.0), ("d", 8, 4.0)]
    return spark.createDataFrame(rows, "g string, id long, w double")


@pytest.mark.parametrize("bucket_rows,chunk", [(1024, 1 << 16), (16, 500)])
def test_shares_follow_the_weights(spark, bucket_rows, chunk):
    df = frame(spark)
    n = spark.createDataFrame([("a", 70_000), ("b", 40_000), ("c", 10), (None, 8_000), ("d", 8_000), ("x", 5)], "g string, n long")
    out = W.weighted_draws(df, "id", "w", ["g"], n, 3, bucket_rows, chunk)
    got = out.toPandas()
    assert {k: len(v) for k, v in got.groupby(got.g.fillna("null"))} == {"a": 70_000, "b": 40_000, "null": 8_000, "d": 8_000}
    for _, part in got.groupby(got.g.fillna("null")):
        assert sorted(part.draw) == list(range(len(part)))
    a = got[got.g == "a"]
    counts = np.bincount(a.id, minlength=700)
    want = np.array([i % 7 for i in range(700)]) / 2100 * 70_000
    assert (counts[want == 0] == 0).all()
    chi = ((counts - want)[want > 0] ** 2 / want[want > 0]).sum()
    assert abs(chi - 599) < 5 * np.sqrt(2 * 599)
    heavy = (got[got.g == "b"].id == 1000)
    assert abs(heavy.sum() - 20_000) < 5 * 100  # half of all draws are one row's
    early = heavy[got[got.g == "b"].draw < 4_000].sum()
    assert abs(early - 2_000) < 5 * np.sqrt(4_000 / 4)  # and come at any number
    assert abs((got[got.g.isna()].id == 6).sum() - 6_000) < 5 * np.sqrt(8_000 * 0.25 * 0.75)
    assert abs((got[got.g == "d"].id == 9).sum() - 4_000) < 5 * np.sqrt(8_000 / 4)  # copies count together
    again = W.weighted_draws(df.repartition(5), "id", "w", ["g"], n, 3, bucket_rows, chunk)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_a_heavy_row_is_no_hot_task(spark):
    rows = spark.range(2000).select(F.lit("g").alias("g"), "id", F.when(F.col("id") == 7, 1999.0).otherwise(1.0).alias("w"))
    n = spark.createDataFrame([("g", 200_000)], "g string, n long")
    out = W.weighted_draws(rows, "id", "w", ["g"], n, chunk_draws=5_000)
    most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 200_000 / 8 * 2.5  # the heavy bucket's draws are spread over the partitions


def test_bad_and_no_weights(spark):
    n = spark.createDataFrame([("a", 5)], "g string, n long")
    for w in (-1.0, float("nan"), float("inf")):
        bad = spark.createDataFrame([("a", 1, 1.0), ("a", 2, w)], "g string, id long, w double")
        with pytest.raises(Exception, match="weight"):
            W.weighted_draws(bad, "id", "w", ["g"], n).collect()
    assert W.weighted_draws(frame(spark).limit(0), "id", "w", ["g"], n).collect() == []

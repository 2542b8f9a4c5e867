"""Selection operators on the recorded histories (FIXTURES.md section 3)."""

import os

import pytest
from pyspark.sql import functions as F

from labelkiln.functions.columns import linspace
from labelkiln.operators import selection as S

FIX = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")


def _table(section_title):
    lines = open(FIX, encoding="utf-8").read().split("\n")
    start = next(i for i, l in enumerate(lines) if l.startswith("### ") and section_title in l)
    rows = []
    for l in lines[start + 1:]:
        if l.startswith("### ") or l.startswith("## "):
            break
        if l.startswith("|") and not l.startswith("|---"):
            rows.append([c.strip() for c in l.strip("|").split("|")])
    return rows[0], rows[1:]


@pytest.fixture(scope="module")
def epochs_table():
    return _table("3.1")


def test_first_best_epoch_matches_recorded(spark, epochs_table):
    head, rows = epochs_table
    data, expected = [], {}
    for r in rows:
        key = (r[0], r[1], r[2], r[3])
        for e in range(1, 6):
            data.append((*key, e, float(r[4 + e - 1])))
        expected[key] = int(r[9])
    df = spark.createDataFrame(data, "head string, encoder string, label string, metric string, epoch int, value double")
    g = ["head", "encoder", "label", "metric"]
    best = {tuple(r[c] for c in g): r["best_epoch"] for r in S.first_argmax(df, g).collect()}
    assert best == expected
    # the last saved epoch of the running-best rule is the same epoch
    saved = S.running_best(df, g).filter("saved").groupBy(*g).agg(F.max("epoch").alias("e")).collect()
    assert {tuple(r[c] for c in g): r["e"] for r in saved} == expected


def test_sweep_best_threshold_is_recorded_one(spark):
    head, rows = _table("3.2")
    grid = linspace(0.45, 0.55, 26)
    data = []
    for j, r in enumerate(rows):
        assert abs(float(r[0]) - grid[j]) < 1e-12
        for e in range(1, 6):
            data.append((grid[j], e, float(r[e])))
    df = spark.createDataFrame(data, "threshold double, epoch int, f1 double")
    mean = S.mean_over(df, ["threshold"], "f1", "mean_f1")
    got = {round(r["threshold"], 3): r["mean_f1"] for r in mean.collect()}
    for r in rows:
        assert abs(got[round(float(r[0]), 3)] - float(r[6])) < 1e-8
    best = S.best_threshold(mean.withColumn("g", F.lit(1)), ["g"]).collect()[0]
    assert best["best_threshold"] == 0.45
    assert abs(best["best_mean_f1"] - 0.676331902) < 1e-8


def test_linspace_matches_numpy():
    import numpy as np
    for a, b, n in [(0.45, 0.7, 26), (0.45, 0.55, 26), (0.0, 1.0, 11)]:
        assert linspace(a, b, n) == list(np.linspace(a, b, n))

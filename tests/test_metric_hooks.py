"""Metrics that a caller registers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.operators import metrics as M


@pytest.fixture
def hooks(monkeypatch):
    monkeypatch.setattr(M, "METRICS", {})
    monkeypatch.setattr(M, "TASK_METRICS", dict(M.TASK_METRICS))


def test_built_summed_and_built_in_metrics_together(spark, hooks):
    M.register_metric("share", lambda pred, label: F.avg((pred == 1).cast("int")))
    M.register_metric("max_gap", M.SummedMetric(lambda p, y: np.array([np.abs(p - y).sum(), len(p)]), lambda v: v[0] / v[1]))
    M.register_task_metrics("own", ("acc", "share", "max_gap"))
    M.register_task_metrics("only", ("max_gap",))
    M.register_task_metrics("both", ("pearson", "acc"))
    rows = [("own", 1.0, 1.0), ("own", 1.0, 0.0), ("own", 0.0, 0.0), ("only", 3.0, 1.0), ("only", 0.0, 1.0),
            ("both", 1.0, 1.0), ("both", 2.0, 3.0), ("both", 4.0, 5.0)]
    df = spark.createDataFrame(rows, "task string, pred double, label double").repartition(3)
    got = {(r["task"], r["metric"]): r["value"] for r in M.task_metrics(df).collect()}
    assert got.keys() == {("own", "acc"), ("own", "share"), ("own", "max_gap"), ("only", "max_gap"), ("both", "pearson"), ("both", "acc")}
    assert got["own", "acc"] == pytest.approx(2 / 3) and got["own", "share"] == pytest.approx(2 / 3)
    assert got["own", "max_gap"] == pytest.approx(1 / 3) and got["only", "max_gap"] == 1.5
    assert got["both", "acc"] == pytest.approx(1 / 3)
    one = {r["metric"]: r["value"] for r in M.compute_task_metrics(df.filter("task = 'own'").drop("task"), "own").collect()}
    assert one == pytest.approx({m: v for (t, m), v in got.items() if t == "own"})


def test_unknown_and_built_in_names_are_errors(hooks):
    with pytest.raises(KeyError):
        M.register_task_metrics("x", ("acc", "never_heard_of"))
    with pytest.raises(ValueError):
        M.register_metric("acc", lambda p, y: F.lit(1.0))

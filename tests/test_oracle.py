"""Every registered query against its DuckDB oracle (sf from LK_TEST_SF,
default sf0.001 for speed; the driver's gate runs sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = os.environ.get("LK_TEST_SF", "/root/testdata/sf0.001")
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    problems = compare(spark, con, SF, E.queries()[name], ORACLE[name])
    assert not problems, problems


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["split", "encoder", "label_name", "epoch", "acc", "f1"]


FITS = {"fit_label_classifiers", "epoch_metrics_from_fits", "fit_pooled_classifier", "model_round_trip",
        "fit_objective_history", "fit_label_classifiers_rows", "fit_pooled_classifier_rows", "epoch_metrics_rows",
        "model_round_trip_rows",
        # the same run and scoring as minibatch_checks and fitted_threshold_sweep, which are audited
        "minibatch_epoch_metrics", "minibatch_loss_history", "model_store_rows"}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - FITS))
def test_plan_has_no_cartesian_or_nested_loop_join(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

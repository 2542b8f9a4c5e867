"""Property tests: distributed operators against brute force on random tables."""

from hypothesis import HealthCheck, given, settings, strategies as st

from labelkiln.functions.columns import linspace
from labelkiln.operators import metrics as M
from labelkiln.operators import selection as S

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 1),
                             st.integers(0, 12).map(lambda k: k / 12)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y != 1]
    if not pos or not neg:
        return None
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))


@SETTINGS
@given(rows=rows_st, buckets=st.integers(1, 9))
def test_auc_equals_pairwise_count(spark, rows, buckets):
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, ["g"], buckets=buckets).collect()}
    for g in {r[0] for r in rows}:
        exp = _brute_auc([(y, p) for gg, y, p in rows if gg == g])
        assert (got[g] is None) == (exp is None)
        if exp is not None:
            assert abs(got[g] - exp) < 1e-12


@SETTINGS
@given(rows=rows_st)
def test_sweep_equals_per_threshold_counts(spark, rows):
    grid = linspace(0.2, 0.8, 7)
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {(r["g"], r["threshold"]): (r["tp"], r["fp"], r["fn"], r["tn"])
           for r in S.threshold_sweep(df, ["g"], grid).collect()}
    for g in {r[0] for r in rows}:
        part = [(y, p) for gg, y, p in rows if gg == g]
        for t in grid:
            tp = sum(1 for y, p in part if p >= t and y == 1)
            fp = sum(1 for y, p in part if p >= t and y != 1)
            fn = sum(1 for y, p in part if p < t and y == 1)
            tn = sum(1 for y, p in part if p < t and y != 1)
            assert got[(g, t)] == (tp, fp, fn, tn)

"""The training rows are written once, and looked up in parts."""

import numpy as np
import pyarrow as pa

from labelkiln.operators import minibatch as MB


def test_a_row_is_written_once_however_often_it_is_drawn(spark):
    draws = [(name, k, k % 3, int(k % 3 == 0)) for name in ("one", "two") for k in range(40)]
    frame = spark.createDataFrame(draws, "label_name string, draw long, doc_id long, y int")
    features = spark.createDataFrame([(d, [d, d, 1]) for d in range(5)], "doc_id long, idx array<int>")
    got = MB.batch_rows(frame, features, ("one", "two"), 20, 10).collect()
    assert len(got) == 3
    assert sum(t["n"] for r in got for turns in r["turns"].values() for t in turns) == len(draws)


def test_rows_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    idx = pa.array([rng.integers(0, 8, n).tolist() for n in (3, 0, 50, 1, 0, 7, 2)], pa.list_(pa.int32()))
    monkeypatch.setattr(MB, "CELLS", 12)
    parts = list(MB.pieces(idx, 4))
    assert parts[0][0] == 0 and parts[-1][1] == len(idx) and all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and len(parts) > 3
    w = rng.normal(size=(9, 4))
    whole = MB.margins(idx, w)[0]
    assert all((MB.margins(idx.slice(a, b - a), w)[0] == whole[a:b]).all() for a, b in parts)
    assert (MB.margins(idx, w[:, :2])[0] == whole[:, :2]).all()  # a column does not depend on the others

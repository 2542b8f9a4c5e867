"""Embedding near-duplicates against brute force."""

import numpy as np
import pytest

from labelkiln.llm.embedding_dedup import TURNS, Caps, first_shared, near_duplicates, smallest_members, unit

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, k1 long, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, 8, "x") for i, v, label in rows], SCHEMA)


def brute(rows, cosine=0.93):
    ok = [v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
          for _, v, label in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    up[root(i)] = root(j)
    low = {}
    for i, (vec_id, *_) in enumerate(rows):
        if vec_id is not None:
            low[root(i)] = min(low.get(root(i), vec_id), vec_id)
    return sorted(((r[0], links[i], low.get(root(i)), r[0] == low.get(root(i))) for i, r in enumerate(rows)), key=str)


def told(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


def clustered(seed, n, dim=16, noise=0.06):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, dim))
    x = centres[rng.integers(0, len(centres), n)] + noise * rng.standard_normal((n, dim)) * np.sqrt(dim) / 4
    return [(int(i), x[i].astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"chunk_rows": 4}])  # 4: most filters are verified as pairs of chunks
def test_clusters(spark, how):
    rows = clustered(1, 300)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)]  # copies
    assert told(near_duplicates(frame(spark, rows), **how)) == brute(rows)


def test_edge_rows(spark):
    v = clustered(2, 12)
    rows = [*v, (None, v[0][1], v[0][2]), (None, [1.0, 2.0], 5), (3, v[3][1], v[3][2]), (20, None, 1), (21, [], 1),
            (22, [0.0] * 16, 1), (23, [float("nan")] * 16, 1), (24, [float("inf")] + [1.0] * 15, 1),
            (25, [None] + [1.0] * 15, 1), (26, v[1][1], None), (27, v[1][1][:8], v[1][2]), (28, [2.0], 1), (29, [3.0], 1),
            (30, [-2.0], 1), (31, [1e30] * 16, 1), (32, [1e-30] * 16, 1), (33, [-0.0, 1.0], 1), (34, [0.0, 1.0], 1)]
    assert told(near_duplicates(frame(spark, rows))) == brute(rows)
    assert told(near_duplicates(frame(spark, []))) == []


def test_random_directions_at_the_border():
    """Recall at exactly the wanted cosine, the hardest pairs, as the fit promises."""
    from labelkiln.llm.embedding_dedup import caps
    made, alpha = caps(64, 10, 2, 0.93, 11)
    rng = np.random.default_rng(99)
    a, b = unit(rng.standard_normal((1500, 64))), rng.standard_normal((1500, 64))
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    (i, f), (j, g) = made.passed(a, alpha), made.passed(b, alpha)
    assert len({r for r, _ in {*zip(i, f)} & {*zip(j, g)}}) >= 0.965 * 1500


def test_listed_filters_are_those_that_reach_the_threshold():
    made = Caps(6, 5, 2, 3)
    x = unit(np.random.default_rng(1).standard_normal((40, 6)))
    row, name = made.passed(x, 0.4)
    want = set()
    for turn in range(TURNS):
        y = x @ made.rotate[turn]
        a, b = made.codes[turn]
        for p in range(5):
            for q in range(5):
                reached = np.flatnonzero(y @ np.r_[a[p], b[q]] >= 0.4)
                want |= {(int(r), (turn * 5 + p) * 5 + q) for r in reached}
    assert set(zip(row.tolist(), name.tolist())) == want and len(row) == len(want)


def test_first_shared_and_components():
    lists = np.array([[1, 4, 6], [4, 6, -1], [6, 9, -1]])
    i, j = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert first_shared(lists, i, j, 4).tolist() == [True, True, True][:1] + first_shared(lists, i[1:], j[1:], 4).tolist()
    assert first_shared(lists, i, j, 6).tolist() == [False, True, True]
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    label = smallest_members(400, a, b)
    assert (label[a] == label[b]).all() and (label <= np.arange(400)).all() and (label[label] == label).all()
    up = list(range(400))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = sorted((root(x), root(y)))
        up[y] = x
    assert label.tolist() == [root(x) for x in range(400)]

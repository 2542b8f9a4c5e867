"""Fitted operators and the pipeline: resampling, toxicity, neighbours, stages."""

import itertools
import pickle
import random

import numpy as np
import pytest
from llm_data import PROSE, edge_rows, words
from pyspark.sql import functions as F

import corpus_pipeline as P
from labelkiln.llm import neighbours as N
from labelkiln.llm import resampling as Q
from labelkiln.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int, extra string"


# --------------------------------------------------------------- resampling
def junk(seed, n):
    r = random.Random(seed)
    return r.choice([lambda: " ".join(w.upper() + "!!" for w in words(seed, n).split()),
                     lambda: " ".join([r.choice(PROSE)] * n),
                     lambda: " | ".join(words(seed, n).split()),
                     lambda: " ".join(w + r.choice(["***", "$$$", "&&&"]) for w in words(seed, n).split())])()


@pytest.fixture
def graded(spark, docs):
    rows = [(i, junk(i, 60) if i % 5 == 0 else words(i, 60)) for i in range(300)]
    labels = [(i, int(i % 5 != 0), 0, "x") for i in range(300) if i % 2] + [(i, 0, 0, "x") for i in range(0, 300, 10)]
    labels += [(None, 1, 0, "x"), (5000, 1, None, "x"), (7, None, 0, "x")]
    return rows, docs(rows), spark.createDataFrame(labels, LABELS)


def test_junk_goes_and_clean_documents_stay(graded):
    rows, df, labels = graded
    got = {r["doc_id"]: r for r in Q.draw(df, labels).collect()}
    assert len(got) == len(rows)
    assert sum(got[i]["kept"] for i in range(0, 300, 5)) <= 2
    assert all(got[i]["kept"] for i in range(300) if i % 5)
    kept = Q.resample(df, labels)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if r["kept"])
    assert {r["_weight"] for r in kept.collect()} == {0.5}
    again = {r["doc_id"]: r["drawn"] for r in Q.draw(df.repartition(5), labels).collect()}
    assert all(again[i] == got[i]["drawn"] for i in got)  # to the last bit, in any partitioning


def test_counts_and_weights_equal_brute_force(docs):
    texts = ["a a b", "B a!!", "", None, "  ", "x" * 50 + " 12"]
    df = docs(list(enumerate(texts)))
    counts = Q.gram_counts(df, "text")
    assert counts.sum() == 4 * sum(len((t or "").split()) for t in texts)
    ratio = np.random.default_rng(0).normal(size=Q.BUCKETS)
    got = {r["doc_id"]: r["w"] for r in df.select("doc_id", Q.log_weight("text", ratio).alias("w")).collect()}
    for i, t in enumerate(texts):  # a text's own counts give its weight
        assert got[i] == pytest.approx(float(Q.gram_counts(df.filter(F.col("doc_id") == i), "text") @ ratio), abs=1e-9)


def test_cut_is_the_kth_largest(spark):
    r = random.Random(1)
    for values in ([r.gauss(0, 100) for _ in range(3000)], [1.0] * 50 + [2.0] * 7, [5.0]):
        df = spark.createDataFrame([(v, v) for v in values], "_weight double, _drawn double")
        model = object.__new__(Q.Resampler)
        model.level = sorted(values)[len(values) // 3]
        k = sum(v > model.level for v in values)
        want = sorted(values, reverse=True)[k - 1] if k else float("inf")
        assert model.cut(df) == want
    assert Q.Resampler._level(np.array([1.0, 2, 8, 9]), np.array([0, 0, 1, 1])) == 5.0
    assert Q.Resampler._level(np.array([1.0, 2]), np.array([1, 1])) == float("-inf")


def test_resampling_edges(spark, docs):
    none = spark.createDataFrame([], LABELS)
    df = docs(edge_rows())
    assert Q.resample(df, none).count() == len(edge_rows())
    one_kind = spark.createDataFrame([(4, 1, 0, "x")], LABELS)
    assert Q.resample(df, one_kind).count() == len(edge_rows())
    assert Q.resample(docs([]), none).count() == 0 and Q.draw(docs([]), one_kind).count() == 0


# ----------------------------------------------------------------- toxicity
def test_subsequence_kernel_equals_its_definition():
    def brute(a, b):
        total = 0
        for i in itertools.combinations(range(len(a)), X.ORDER):
            for j in itertools.combinations(range(len(b)), X.ORDER):
                if all(a[x] == b[y] for x, y in zip(i, j)):
                    total += X.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total
    some = ["idiot", "idxiot", "scum", "aaab", "", "ab", "trash", "thrash", "ñandú"]
    trie = X.Subsequences(some)
    k = trie.sums(some, trie.vectors.T)
    assert np.allclose(k, [[brute(a, b) for b in some] for a in some], atol=1e-5)
    assert np.allclose(X.self_kernel(some), [brute(a, a) for a in some])
    assert np.allclose(np.diag(X.similarity(some, some))[[0, 1, 2, 3, 6, 7, 8]], 1, atol=1e-5)


def test_value_of_a_word_is_that_of_the_kernel_expansion():
    r = random.Random(3)
    some = ["".join(r.choice("abcdeñ") for _ in range(r.randrange(12))) for _ in range(300)] + ["q" * 40, "abcab" * 12]
    machine = X.Machine(["abcab", "edcba", "aaa", "bdbdbd", "abñde"])
    machine.set_weights(np.array([1.0, -0.5, 0.3, 0.2, 2.0]), -0.7)
    short = [w for w in some if len(w) <= X.WIDEST]
    want = X.similarity(short, machine.landmarks) @ machine.weights + machine.bias
    assert np.allclose(machine.plain_values(short), want)
    assert np.allclose(machine.similarity(short) @ machine.weights - 0.7, want)
    # a word's value is the highest of its own and of its beginnings
    highest = [max(machine.plain_values([w, *X.stems(w)])) for w in short]
    assert np.allclose(machine.values(short), highest)
    sent = pickle.dumps(machine)
    assert len(sent) < 10_000 and (pickle.loads(sent).values(some) == machine.values(some)).all()
    parts = X.windows("abcab" * 12)
    assert machine.values(["abcab" * 12])[0] == pytest.approx(machine.values(parts).max())
    assert "".join(p[: X.WIDEST // 2] for p in X.windows("ab" * 80))[:144] == ("ab" * 80)[:144]


def test_inserted_letters():
    for n in (1, 2, 3):
        grown = X.inserted(["idiot", "scum", "stupid", "idiot"], n, 5)
        assert len(grown) == 10 and all(len(g) == len(w) + n for g, w in zip(grown, ["idiot"] * 5 + ["stupid"] * 5))
        assert all(X.similarity([w], [g])[0, 0] > 0 for w, g in zip(["idiot"] * 5, grown))
        assert all(g[0] == "i" and g[-1] == "t" for g in grown[:5])


@pytest.fixture(scope="module")
def judged(spark):
    insults = ["grobulax", "fremdozit", "pluvertin"]
    rows, labels = [], []
    for i in range(400):
        w = words(i, 40).split()
        if i % 4 == 0:
            for _ in range(2):
                w.insert(random.Random(i).randrange(len(w)), insults[i // 4 % 3])
        rows.append((i, " ".join(w[:20]) + ".\n" + " ".join(w[20:]) + "."))
        labels.append((i, 1, int(i % 4 == 0), "x"))
    hidden = ["gro.bulax", "g-r-o-b-u-l-a-x", "fremdoozit", "plu*vertin", "f r e m d o z i t", "pluvxertin"]
    rows += [(1000 + i, f"{words(900 + i, 12)} {h} {words(950 + i, 12)}") for i, h in enumerate(hidden)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (None, "grobulax"), (2003, "a" * 20_000), (2004, "x y z")]
    rows += [(2005, words(1, 5000) + " fremdozit " + words(2, 5000)), (2006, words(3, 10_000)), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1, 1, "x"), (3, 1, None, "x")], LABELS)
    scored = X.score(df.withColumn("score_", F.lit(1)), lab, F.col("doc_id") % 5 != 2).collect()
    return rows, scored, df, lab


def test_held_out_insults_are_found_and_clean_texts_left(judged):
    rows, scored, _, _ = judged
    assert len(scored) == len(rows)
    by = {r["doc_id"]: r["score"] for r in scored}
    assert all((by[i] >= 0.3) == (i % 4 == 0) for i in range(400))
    assert all(by[1000 + i] >= 0.3 for i in range(6)), {i: by[1000 + i] for i in range(6)}
    assert by[None] >= 0.3 and by[2005] >= 0.3
    assert all(by[i] < 0.3 for i in (2000, 2001, 2002, 2003, 2004, 2006))
    assert all(0 <= s <= 1 for s in by.values())


def test_toxicity_edges(spark, judged):
    _, _, df, lab = judged
    assert {r["score"] for r in X.score(df, lab.filter("toxic = 0"), F.lit(True)).collect()} == {0.0}
    assert X.score(df.limit(0), lab, F.lit(True)).count() == 0


# --------------------------------------------------------------- neighbours
def vector_rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = [(centres[i % 12] + 0.2 * rng.normal(size=16)).astype(np.float32).tolist() for i in range(600)]
    rows = [(i, v, 1, "extra") for i, v in enumerate(x)]
    rows += [(1000 + i, x[0], 1, "copy") for i in range(100)]  # one vector held by many ids, queries among them
    rows += [(2000, None, 1, ""), (2001, [0.0] * 16, 1, ""), (2002, [float("nan")] * 16, 1, ""), (2003, [], 1, ""),
             (2004, [1.0, None] + [0.0] * 14, 1, ""), (2005, [1.0] * 5, 1, ""), (2006, [float("inf")] + [0.0] * 15, 1, ""),
             (None, x[5], 1, ""), (7, x[7], 1, "repeated")]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def brute_neighbours(rows, k, every):
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = np.array(v, np.float64)
    ids = np.array(sorted(ok))
    x = np.stack([ok[i] for i in ids])
    out = {}
    for i in ids[ids % every == 0]:
        d = np.sqrt(((ok[i] - x) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), d[j]) for j in order]
    return out


@pytest.mark.parametrize("chunk", [4096, 16])  # 16: buckets are dealt into chunks
def test_neighbours_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(N, "CHUNK", chunk)
    rows = vector_rows()
    got = {}
    for r in N.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_neighbours(rows, 10, 20)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    distance = {}
    hits = 0
    for q in want:
        hits += len({v for v, _ in want[q]} & {v for v, _ in got[q]})
        assert [s for _, s in got[q]] == sorted(s for _, s in got[q])
    assert hits / (10 * len(want)) >= 0.9
    assert got[0] == want[0] and got[1000] == want[1000]  # ties of equal vectors go to the smaller id
    del distance


def test_few_vectors_give_all_candidates(spark):
    rows = [(20 * i, [float(i), 1.0], 1, "") for i in range(4)]
    df = spark.createDataFrame(rows, VECTORS)
    got = [tuple(r) for r in N.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 20), (0, 2, 40), (0, 3, 60), (20, 1, 0), (20, 2, 40), (20, 3, 60),
                                                (40, 1, 20), (40, 2, 60), (40, 3, 0), (60, 1, 40), (60, 2, 20), (60, 3, 0)]
    assert N.nearest(df.limit(0), F.lit(True)).count() == 0
    assert N.nearest(df.limit(1), F.lit(True)).count() == 0


def test_probes_come_in_order_of_their_cost():
    t = N.Tables(8, 1, 5, 1.0, 3)
    inside = np.array([0.1, 0.45, 0.8, 0.5, 0.3])
    keys = t.visit(np.zeros(5, np.int64), inside, 30).tolist()
    cost = {}
    for move in itertools.product((-1, 0, 1), repeat=5):
        c = sum((x if m < 0 else 1 - x) ** 2 for m, x in zip(move, inside) if m)
        cost[int(t.key(np.array([move], np.int64))[0])] = c
    assert [cost[k] for k in keys] == pytest.approx(sorted(cost.values())[:30])


# ----------------------------------------------------------------- pipeline
def test_stages_take_effect_and_keep_the_columns(spark, tmp_path, docs):
    rows = [(i, junk(i, 60) if i % 5 == 0 else words(i, 60), "en", "ab"[i % 2]) for i in range(200)]
    rows += [(300 + i, words(1, 60), "en", "a") for i in range(5)]  # copies of document 1
    rows += [(400, words(400, 60) + " mail jane.doe@example.com now", "en", "b")]
    plain = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 5 != 0), 0, "x") for i in range(200)], LABELS).write.parquet(
        str(tmp_path / "labels.parquet"))
    df, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, df, str(tmp_path))
        if i < len(P.STAGES) - 1:
            assert out.columns == plain.columns
        out.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        seen[name] = df.collect()
    ids = {name: sorted({r["doc_id"] for r in got}) for name, got in seen.items()}
    clean = [i for i in range(200) if i % 5]
    assert set(clean) | {*range(300, 305), 400} <= set(ids["quality"]) and len(ids["quality"]) <= len(clean) + 8
    assert len(seen["near_dedup"]) == len(ids["near_dedup"]) and not {*range(300, 305)} & {*ids["near_dedup"]}
    assert ids["pii"] == ids["near_dedup"]
    mail = next(r for r in seen["pii"] if r["doc_id"] == 400)
    assert "jane.doe" not in mail["text"] and "@example.com" in mail["text"] and mail["n_chars"] == len(mail["text"])
    total = sum(len(r["text"].split()) for r in seen["pii"])
    assert abs(sum(len(r["text"].split()) for r in seen["mixing"]) - total) <= 120
    assert len(seen["bpe"]) == len(seen["mixing"]) and all(r["n_tokens"] == len(r["ids"]) for r in seen["bpe"])
    whole = P.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, seen["bpe"]))


def test_stages_take_empty_and_strange_tables(spark, tmp_path, docs):
    spark.createDataFrame([(1, 1, 0, "x"), (4, 0, 0, "x")], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    for rows in ([], edge_rows()):
        df = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in P.STAGES:
            assert stage(spark, df, str(tmp_path)).count() <= 3 * max(len(rows), 1)


def test_nearest_by_product_equals_differences(monkeypatch):
    monkeypatch.setattr(N, "DISTANCES", 256)  # many small steps
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(300, 6)) * 1e6 + 1e9, rng.normal(size=(300, 6))])  # large equal parts, small ones
    x[400:420] = x[400]
    ids, q = np.arange(600) * 3, x[::40]
    best = N.Nearest(ids[::40], q, 7)
    for some in (rng.permutation(600), np.arange(100)):  # entries seen twice count once
        best.add(np.arange(len(q)), ids[some], x[some])
    got = best.result().to_pydict()
    d = N.distances(q, x)
    want = [(int(ids[40 * i]), int(ids[j]), d[i, j]) for i in range(len(q)) for j in np.lexsort((ids, d[i]))[:7]]
    assert list(zip(got["qid"], got["vid"], got["score"])) == want

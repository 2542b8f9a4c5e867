"""SimHash near-duplicates and substring removal against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_data import edge_rows, words

from labelkiln.llm import simhash as S
from labelkiln.llm import substrings as U
from labelkiln.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(fps, max_bits):
    """fps: list of ints -> smallest index reachable, per index."""
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    arr = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= max_bits):
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def near_texts(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        base = words(i % 7, 400).split()
        for _ in range(r.choice([0, 0, 1, 2, 6])):
            base[r.randrange(len(base))] = f"changed{r.randrange(99)}"
        out.append(" ".join(base) if i % 5 else words(1000 + i, 60))
    return out


def test_fingerprints_and_components_equal_brute_force(docs):
    texts = [*near_texts(60, 1), "", None, "one", "Two Words", "TWO words", "ÄRGER über Äpfel und Ölsardinen heute"]
    got = {r["doc_id"]: r for r in S.near_duplicates(docs(list(enumerate(texts)))).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [got[i]["fingerprint"] & (2**64 - 1) for i in range(len(texts))] == fps
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(fps, 4)


@pytest.mark.parametrize("group_rows", [1 << 16, 8])  # 8: groups are dealt into chunk pairs
def test_trie_join_on_dense_clusters_and_chains(spark, group_rows):
    r = random.Random(5)
    fps = []
    for _ in range(6):
        base = r.getrandbits(64)
        for _ in range(60):
            fps.append(base ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))))
    chain = r.getrandbits(64)
    for i in range(16):  # every neighbour 4 bits apart
        fps.append(chain ^ ((1 << 4 * i) - 1))
    fps = sorted({f for f in fps} | {r.getrandbits(64) for _ in range(200)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = connected_components(S.spanning_links(df, 4, group_rows)).collect()
    root = {x["node"] & (2**64 - 1): x["root"] & (2**64 - 1) for x in links}
    groups = {}
    for f, c in zip(fps, brute_components(fps, 4)):
        groups.setdefault(c, set()).add(f)
    got = {}
    for f in fps:
        got.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {i: 100 for i in range(101, 160)}
    assert connected_components(df.limit(0)).count() == 0


def test_simhash_edges(docs):
    got = S.near_duplicates(docs(edge_rows())).collect()
    assert len(got) == len(edge_rows())
    zero = [r for r in got if r["fingerprint"] == 0]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    assert S.near_duplicates(docs([])).count() == 0


def test_keep_one_keeps_one_row_of_each_component(docs):
    rows = edge_rows()
    df = docs(rows)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert set(got.values()) == {1}
    assert set(got) == {(1, ""), (3, "one"), (4, words(1, 30_000)), (6, words(2, 80)), (6, words(3, 80))}
    assert {r["_content"] for r in kept.collect()} == {1}  # the extra column is untouched
    assert S.keep_one(docs([])).count() == 0


def brute_removal(texts, window):
    """texts: (doc_id, text) -> (n_words, n_removed, sha256)."""
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in texts]
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def removed(df, window):
    return [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest())
            for r in U.remove_repeats(df, window=window).collect()]


@pytest.mark.parametrize("window", [50, 8])
def test_substrings_equal_brute_force(docs, window):
    r = random.Random(3)
    passages = [words(100 + i, r.choice([window, window + 1, 2 * window, 3 * window, window - 1])) for i in range(8)]
    rows = []
    for i in range(50):
        parts = [words(500 + i, r.randrange(5, 120))]
        for _ in range(r.randrange(3)):
            p = r.choice(passages).split()
            if r.random() < 0.4:
                p[r.randrange(len(p))] = "edited"
            parts.insert(r.randrange(len(parts) + 1), " ".join(p))
        rows.append((r.randrange(40), "\n".join(parts)))  # ids repeat
    rows += [(90, "ab " * 200), (91, "ab " * 150), (92, "ab " * 30 + words(1, 60))]
    assert sorted(removed(docs(rows), window)) == sorted(brute_removal(rows, window))


def test_substring_edges(docs):
    rows = [(r[0], r[1]) for r in edge_rows()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(removed(docs(edge_rows()), 50), key=key) == sorted(brute_removal(rows, 50), key=key)
    assert U.remove_repeats(docs([])).count() == 0
    with pytest.raises(ValueError):
        U.remove_repeats(docs([]), window=7)


def test_long_texts_are_cut_into_overlapping_blocks(monkeypatch):
    monkeypatch.setattr(U, "BLOCK", 300)
    text = words(4, 2000).split()
    spans = []
    for held in U._blocks([("k", [w.encode() for w in text])], 25):
        for _, offset, piece in held:
            spans.append((offset, offset + len(piece) - 49))
    assert spans[0][0] == 0 and spans[-1][1] == 2000 - 49
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_windows_whose_runs_pass_a_byte_are_removed_whole(docs):
    text = words(8, 1500)
    got = {r["doc_id"]: r for r in U.remove_repeats(docs([(1, text), (2, text)]), window=700).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 1500 and got[2]["kept"] == ""

"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import edge_rows

from labelkiln.llm.spelling import near_words, one_edit_pairs, variant_groups, vocabulary


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(vocab, ratio=2):
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    best = {w: min(near[w], key=lambda v: (-vocab[v], v)) for w in vocab if near[w]}
    form = {w: b for w, b in best.items() if vocab[b] >= ratio * vocab[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), vocab[form[w]] if w in form else None) for w, n in vocab.items()}


def some_vocab(seed, letters="abé", n=250, longest=7):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randrange(1, longest))): r.randrange(1, 60) for _ in range(n)}


def test_sorted_scan_finds_all_pairs_of_a_group():
    r = random.Random(1)
    for _ in range(60):
        rows = sorted({(g, "".join(r.choice("abc") for _ in range(r.randrange(6)))) for g in range(3)
                       for _ in range(r.randrange(1, 25))})
        q, y = one_edit_pairs(np.array([g for g, _ in rows]), [w for _, w in rows], np.arange(len(rows)))
        got = list(zip(q.tolist(), y.tolist()))
        want = {(i, j) for i, (g, a) in enumerate(rows) for j, (h, b) in enumerate(rows) if g == h and one_edit(a, b)}
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("group_rows", [4096, 3])  # 3: every group is split down to single positions
def test_forms_and_roots(spark, group_rows):
    vocab = some_vocab(group_rows) | {"lone" * 300: 5, "lone" * 300 + "x": 2, "x" * 40: 9, "x" * 41: 20, "x" * 42: 41}
    words = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = variant_groups(words, group_rows=group_rows).collect()
    assert len(got) == len(vocab)
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got} == brute(vocab)


def test_one_context_for_all_words(spark):
    """All words share their first half: the group is split by the rest, nothing is lost."""
    vocab = {"commonstart" + w: n for w, n in some_vocab(5, "abcdef", 600, 9).items()}
    words = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = {r["word"]: r["n_near"] for r in near_words(words, group_rows=16).collect()}
    assert got == {w: n for w, _, _, _, n, _ in brute(vocab) if n}


def test_vocabulary(spark, docs):
    rows = [*edge_rows(), (50, "Élan ÉLAN élan naïve Naïve NAÏVE naÏve a×b÷c 123ab_cd"), (51, "Hello hello HELLO hello-hello")]
    want = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            want[run if h % 3 else run[: h % len(run)] + run[h % len(run) + 1:]] += 1
    got = {r["word"]: r["n"] for r in vocabulary(docs(rows), min_length=4, min_count=2, typo_every=3).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 4 and n >= 2}


def test_nothing(spark, docs):
    assert variant_groups(vocabulary(docs([]))).collect() == []
    assert variant_groups(vocabulary(docs([(1, None), (2, "")]))).collect() == []

"""Spelling variants: words one edit apart, grouped under their frequent form.

Two words are near if one inserted, deleted or replaced code point turns one into
the other. A word's form is its most frequent near word, if that is at least
``ratio`` times as frequent; following forms leads to the word's root.

Search: the vocabulary is sorted and scanned by dynamic programming. A row of the
edit matrix (its three cells beside the diagonal) is computed once for a run of
sorted words that share a prefix, as their adjacent longest common prefixes tell,
and is the start of all longer prefixes in the run; once all three cells exceed one
edit the whole run is skipped. All query words of a block go down together.

Distribution: let ``L`` be the shorter word's length. The one edit lies in one block
``[lo, hi)`` of its positions, so both words agree before ``lo`` and after ``hi``
(counted from the end). Words meet by (L, block, letters before, letters after),
first for the two halves of L. A group of more than ``group_rows`` words is split
again, each half of its block being keyed by the longer context; at a block of one
position a group holds only the letters that fit there, so the splitting ends with
bounded groups and no pair is lost. A pair is reported by the block that holds the
end of its common prefix, hence once. Counts and best partners are summed up inside
a block before they are shuffled; pairs are never written. Roots are found by
doubling pointers; a root shared by very many words is dealt over salts.

Edge cases: a null text has no words; a null id is written as nothing before the
colon of the typo hash; texts and words of any length are whole; a word without a
near word has no form and is its own root; equal counts go to the smaller word in
code-point order; repeated rows count again; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import lookup
from labelkiln.session import cut_lineage

#: Fixed value: a word is a maximal run of these letters.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Different words counted before they are handed on, postings scanned together, matrix rows computed together.
COUNTED, SCAN_ROWS, MATRIX_ROWS = 1 << 17, 1 << 16, 1 << 19


def _count_runs(least: int, typo_every: int | None):
    """(id, text) batches -> partial counts of lower-cased runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                              ["word", "n"])

        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lowered = (text.as_py() or "").encode().lower().decode()  # bytes.lower changes A-Z only
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(RUN.findall(lowered)).items():
                    if typo_every and (h := zlib.crc32(word.encode(), seed)) % typo_every == 0:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                    if len(word) >= least:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield told()
                    counts.clear()
        yield told()

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
               typo_every: int | None = None) -> DataFrame:
    """``word``, ``n`` (occurrences): the lower-cased (A-Z) runs of letters of at least
    ``min_length`` code points that occur ``min_count`` times. ``typo_every`` plants
    typos: a run loses one code point where that number divides the CRC-32 ``h`` of
    ``<id>:<run>``, the one at ``h`` modulo its length."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(_count_runs(min_length, typo_every), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _adjacent_prefixes(codes: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Longest common prefix with the word before; -1 at the start of a group."""
    lcp = np.full(len(size), -1, np.int64)
    live = np.flatnonzero(group[1:] == group[:-1]) + 1
    lcp[live] = 0
    while len(live):
        at = lcp[live]
        live = live[at < np.minimum(size[live], size[live - 1])]
        same = codes[start[live] + lcp[live]] == codes[start[live - 1] + lcp[live]]
        live = live[same]
        lcp[live] += 1
    return lcp


def one_edit_pairs(group: np.ndarray, words: list[str], queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, other) of words at edit distance one inside a group, where other is
    as long as the query or longer by one. ``words`` are distinct within their group and
    sorted by (group, word); ``queries`` are positions of those that ask."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size) - size
    codes = np.r_[codes, np.uint32(0xFFFFFFFF)]  # read, never matched, past the last word
    lcp = _adjacent_prefixes(codes, start, size, group)
    first = np.flatnonzero(lcp < 0)
    last = np.r_[first[1:], len(words)]
    which = np.searchsorted(first, queries, "right") - 1
    cuts: dict[int, np.ndarray] = {}
    found_q, found_y = [], []
    m = size[queries]
    two = np.full(len(queries), 2, np.int8)
    # a node: rows lo..hi agree in their first r letters; its cells: D[r][r-1], D[r][r], D[r][r+1], at most 2
    stack = [(0, queries, first[which], last[which], two, two * 0, np.where(m > 0, 1, 2).astype(np.int8))]
    while stack:
        r, q, lo, hi, below, on, above = stack.pop()
        if not len(q):
            continue
        ends = size[lo] == r
        if ends.any():
            gap = size[q] - r
            cost = np.select([gap == -1, gap == 0, gap == 1], [below, on, above], 2)
            hit = ends & (cost == 1)
            found_q.append(q[hit])
            found_y.append(lo[hit])
            lo = lo + ends
            more = lo < hi
            q, lo, hi, below, on, above = (x[more] for x in (q, lo, hi, below, on, above))
        if r not in cuts:
            cuts[r] = np.flatnonzero(lcp <= r)  # rows that begin another prefix of r + 1 letters
        a, b = np.searchsorted(cuts[r], lo, "right"), np.searchsorted(cuts[r], hi, "left")
        kids = b - a + 1
        if kids.sum() > MATRIX_ROWS and len(q) > 1:
            half = len(q) // 2
            stack += [(r, *(x[half:] for x in (q, lo, hi, below, on, above))),
                      (r, *(x[:half] for x in (q, lo, hi, below, on, above)))]
            continue
        of = np.repeat(np.arange(len(q)), kids)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(kids) - kids, kids)
        begin = np.where(nth == 0, lo[of], cuts[r][np.minimum(a[of] + nth - 1, len(cuts[r]) - 1)])
        stop = np.where(nth == kids[of] - 1, hi[of], cuts[r][np.minimum(a[of] + nth, len(cuts[r]) - 1)])
        q = q[of]
        letter, at, n = codes[start[begin] + r], start[q], size[q]

        def differs(i: int) -> np.ndarray:
            inside = (i >= 0) & (i < n)
            return np.where(inside & (codes[np.where(inside, at + i, len(codes) - 1)] == letter), 0, np.where(inside, 1, 2))

        under = np.minimum(below[of] + differs(r - 1), on[of] + 1)
        mid = np.minimum(np.minimum(on[of] + differs(r), above[of] + 1), under + 1)
        mid = np.where(r + 1 <= n, mid, 2)
        over = np.where(r + 2 <= n, np.minimum(above[of] + differs(r + 1), mid + 1), 2)
        live = np.minimum(np.minimum(under, mid), over) <= 1
        stack.append((r + 1, q[live], begin[live], stop[live],
                      *(np.minimum(c, 2).astype(np.int8)[live] for c in (under, mid, over))))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_q or none), np.concatenate(found_y or none)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings (size, lo, hi, before, after, word, n) -> per word of a block the
    number of its near words met there and the best of them."""

    def scan(rows: pa.Table) -> pa.RecordBatch | None:
        size, lo, hi = (rows.column(i).to_numpy() for i in range(3))
        key = list(zip(size.tolist(), lo.tolist(), hi.tolist(), rows.column(3).to_pylist(), rows.column(4).to_pylist()))
        words = rows.column(5).to_pylist()
        middles = [w[a : len(w) - (s - b)] for w, (s, a, b, _, _) in zip(words, key)]
        order = sorted(range(len(words)), key=lambda i: (key[i], middles[i]))
        words, middles = [words[i] for i in order], [middles[i] for i in order]
        n, size, hi = rows.column(6).to_numpy()[order], size[order], hi[order]
        group = np.cumsum([True, *(key[a] != key[b] for a, b in zip(order, order[1:]))])
        asks = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) == size)
        q, y = one_edit_pairs(group, middles, asks)
        if not len(q):
            return None
        longer = np.fromiter((len(words[i]) for i in y.tolist()), np.int64, len(y)) > size[q]
        # an insertion behind the block's last letter belongs to the next block
        owned = ~longer | (hi[q] == size[q])
        rest = np.flatnonzero(~owned)
        owned[rest] = [not middles[b].startswith(middles[a]) for a, b in zip(q[rest].tolist(), y[rest].tolist())]
        q, y, longer = q[owned], y[owned], longer[owned]
        # equally long words find each other; a longer one is told by the shorter
        me, other = np.r_[q, y[longer]], np.r_[y, q[longer]]
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[other], -n[other], me))
        me, other = me[order], other[order]
        begin = np.flatnonzero(np.r_[True, me[1:] != me[:-1]]) if len(me) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in me[begin].tolist()], pa.string()),
             pa.array(np.diff(np.r_[begin, len(me)])), pa.array(n[other[begin]]),
             pa.array([words[i] for i in other[begin].tolist()], pa.string())], ["word", "n_near", "best_n", "best"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SCAN_ROWS:  # keep the last group back, it may go on
            rows = pa.Table.from_batches(held).combine_chunks()
            tail = [rows.column(i)[-1].as_py() for i in range(5)]
            cut = rows.num_rows
            while cut and all(rows.column(i)[cut - 1].as_py() == tail[i] for i in range(5)):
                cut -= 1
            if cut and (out := scan(rows.slice(0, cut))):
                yield out
            held = rows.slice(cut).to_batches() if cut else rows.to_batches()
    if held and (out := scan(pa.Table.from_batches(held).combine_chunks())):
        yield out


def _posting(size: Column, lo: Column, hi: Column, word: Column) -> Column:
    """A word's key for the edit inside ``[lo, hi)`` of a shorter word of ``size`` letters."""
    length = F.length(word)
    return F.struct(size.cast("int").alias("size"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"),
                    F.substring(word, F.lit(1), lo.cast("int")).alias("before"),
                    F.substring(word, (length - size + hi + 1).cast("int"), (size - hi).cast("int")).alias("after"))


KEY = ["size", "lo", "hi", "before", "after"]


def _halves(rows: DataFrame, size: Column, lo: Column, hi: Column) -> DataFrame:
    """Postings for both halves of a block; an empty half holds no edit."""
    middle, word = F.floor((lo + hi) / 2), F.col("word")
    return (rows.select("word", "n", F.explode(F.array(_posting(size, lo, middle, word), _posting(size, middle, hi, word)))
                        .alias("k")).filter("k.lo < k.hi").select("k.*", "word", "n"))


def near_words(vocab: DataFrame, group_rows: int = 4096) -> DataFrame:
    """``vocab(word, n)`` -> ``word``, ``n_near``, ``best_n``, ``best`` for the words
    that have a near word: how many, and the most frequent of them."""
    length = F.length("word")
    sized = vocab.select("word", "n", F.explode(F.array(length, length - 1)).alias("s")).filter("s > 0")
    todo = cut_lineage(_halves(sized, F.col("s"), F.lit(0), F.col("s")), "postings")
    ready = None
    while True:
        held = todo.groupBy(*KEY).agg(F.count("*").alias("held"))
        counted = cut_lineage(lookup(todo, held, KEY), "postings")
        large = (F.col("held") > group_rows) & (F.col("hi") - F.col("lo") > 1)
        done = counted.filter(~large & (F.col("held") > 1)).drop("held")
        ready = done if ready is None else ready.unionByName(done)
        if counted.filter(large).isEmpty():
            break
        todo = cut_lineage(_halves(counted.filter(large), *(F.col(c) for c in KEY[:3])), "postings")
    dealt = ready.select(*KEY, "word", "n").repartition(*KEY).sortWithinPartitions(*KEY)
    parts = dealt.mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return (parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best")))


def variant_groups(vocab: DataFrame, ratio: int = 2, group_rows: int = 4096) -> DataFrame:
    """``vocab(word, n)`` -> ``word``, ``form`` (null: none), ``root``, ``n``,
    ``n_near``, ``form_n`` for every word."""
    vocab = cut_lineage(vocab.select("word", "n"), "vocabulary")
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = cut_lineage(vocab.join(near_words(vocab, group_rows), "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = formed.filter("form is not null").select("word", F.col("form").alias("at"))
    while True:  # each round doubles the distance followed; counts grow along it, so it is logarithmic
        roots = cut_lineage(roots, "roots")
        ahead = roots.select(F.col("word").alias("at"), F.col("at").alias("next"))
        if roots.join(ahead.select("at"), "at", "left_semi").isEmpty():
            break
        roots = lookup(roots, ahead, ["at"]).select("word", F.coalesce("next", "at").alias("at"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("at", "word").alias("root"), "n", "n_near",
                                                     "form_n")

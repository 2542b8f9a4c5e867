"""SimHash near-duplicates by a binary trie self-join.

Each text gets a 64-bit fingerprint (majority vote per bit over the XXH64 of
its word shingles). Two fingerprints link at ``max_bits`` or fewer differing
bits, and linked documents form a component.

The join reads the fingerprints as paths in a binary trie and descends pairs of
nodes together: a pair's children differ in none or one more bit, and a pair
whose differing bits exceed the budget is dropped with everything below it. To
spread the walk, the 64 bits are cut into ``max_bits + 1`` blocks; of two linked
fingerprints one block is equal (pigeonhole), so for each block the fingerprints
are rotated to begin with it and grouped by its value: every group is one
sub-trie and one unit of work. Inside a group, node pairs whose members are
already known to be connected are dropped as well, so that a dense cluster
costs about its size, and a group returns a spanning set of links
(representative, member) instead of all its pairs. Connectivity, and so the
result, is exact. Groups of more than ``group_rows`` fingerprints are dealt into
chunks and walked as pairs of chunks in tasks of their own.

Equal fingerprints are one row from the start, so exact copies of any number
cost nothing here. Results go back to their rows by salted joins, so neither a very
common fingerprint nor the root of a very large component is one task's work.

Edge cases: a null or wordless text has fingerprint zero and links like any
other; a text of fewer words than a shingle is one shingle; repeated rows are
rows of their own with equal results; a component whose ids are all null has a
null id; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import lookup, spare, utf8_words
from labelkiln.llm.components import connected_components
from labelkiln.session import cut_lineage

#: Fixed value: the seed of the shingle hash.
SEED = 42
#: Shingle hashes turned into bits at a time, node pairs on the work list's entries, rows walked together.
VOTE_BLOCK, NODE_PAIRS, WALK_ROWS = 1 << 14, 1 << 15, 1 << 16


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = [w.lower() for w in utf8_words(text)]  # bytes.lower changes A-Z only
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[words_per_shingle - 1 :].tolist() if len(words) >= words_per_shingle else [len(line)]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, VOTE_BLOCK):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + VOTE_BLOCK], stops[at : at + VOTE_BLOCK])],
                     "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column | str, words_per_shingle: int = 4) -> Column:
    """Fingerprints as signed longs (the same 64 bits)."""

    def udf(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), words_per_shingle) for t in texts], np.uint64).view(np.int64))

    return F.arrow_udf(udf, "long")(text)


def hex_digits(bits: Column) -> Column:
    """16 lowercase hex digits of a long."""
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


class _Links:
    """Component labels over sorted fingerprints; only ever coarsened."""

    def __init__(self, n: int, same_as_before: np.ndarray):
        self.label = np.cumsum(~same_as_before) - 1 if n else np.zeros(0, np.int64)
        self._mark()

    def _mark(self) -> None:
        change = np.ones(len(self.label), np.int64)
        change[1:] = self.label[1:] != self.label[:-1]
        self.run = np.cumsum(change)

    def uniform(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.run[lo] == self.run[hi - 1]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        pairs = np.unique(np.sort(np.stack([self.label[a], self.label[b]]), axis=0), axis=1)
        pairs = pairs[:, pairs[0] != pairs[1]]
        if not pairs.shape[1]:
            return
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        for x, y in pairs.T.tolist():
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        to = np.arange(self.label.max() + 1)
        for x in up:
            to[x] = root(x)
        self.label = to[self.label]
        self._mark()


def trie_links(group: np.ndarray, bits: np.ndarray, max_bits: int, from_bit: int) -> np.ndarray:
    """Component labels of fingerprints (``bits``, unsigned, sorted within their
    sorted ``group``) under links of at most ``max_bits`` bits inside a group.
    All of a group agree in the first ``from_bit`` bits."""
    n = len(bits)
    near = np.zeros(n, bool)
    near[1:] = (group[1:] == group[:-1]) & (np.bitwise_count(bits[1:] ^ bits[:-1]) <= max_bits)
    links = _Links(n, near)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    last = np.r_[first[1:], n] if n else first
    ones: dict[int, np.ndarray] = {}
    # a node is a range of the sorted rows; the work list holds (depth, a, b ranges, differing bits)
    stack = [(from_bit, first, last, first, last, np.zeros(len(first), np.int64))]
    while stack:
        depth, al, ah, bl, bh, diff = stack.pop()
        keep = ~(links.uniform(al, ah) & links.uniform(bl, bh) & (links.label[al] == links.label[bl]))
        al, ah, bl, bh, diff = (x[keep] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        if len(al) > NODE_PAIRS:
            half = len(al) // 2
            stack += [(depth, *(x[half:] for x in (al, ah, bl, bh, diff))),
                      (depth, *(x[:half] for x in (al, ah, bl, bh, diff)))]
            continue
        size = (ah - al) * (bh - bl)
        small = (size <= 64) if depth < 64 else np.ones(len(al), bool)
        if small.any():
            s, w, m = al[small], (bh - bl)[small], size[small]
            which = np.repeat(np.arange(len(s)), m)
            k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            a, b = s[which] + k // w[which], bl[small][which] + k % w[which]
            ok = (a < b) & (links.label[a] != links.label[b])
            a, b = a[ok], b[ok]
            ok = np.bitwise_count(bits[a] ^ bits[b]) <= max_bits
            links.join(a[ok], b[ok])
        if small.all():
            continue
        al, ah, bl, bh, diff = (x[~small] for x in (al, ah, bl, bh, diff))
        if depth not in ones:
            one = (bits >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(one.astype(np.int64))]
        count = ones[depth]
        am, bm = ah - (count[ah] - count[al]), bh - (count[bh] - count[bl])
        apart = (al != bl) | (ah != bh)
        below = []
        for x0, x1, y0, y1, more, use in ((al, am, bl, bm, 0, None), (am, ah, bm, bh, 0, None),
                                          (al, am, bm, bh, 1, None), (am, ah, bl, bm, 1, apart)):
            ok = (x0 < x1) & (y0 < y1) & (diff + more <= max_bits)
            if use is not None:
                ok &= use
            below.append((x0[ok], x1[ok], y0[ok], y1[ok], diff[ok] + more))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*below))))
    return links.label


def _spanning(batches: Iterator[pa.RecordBatch], max_bits: int, from_bits: list[int]) -> Iterator[pa.RecordBatch]:
    """Walks the groups of a sorted partition; whole groups at a time."""

    def walk(block: np.ndarray) -> Iterator[pa.RecordBatch]:
        for turn, from_bit in enumerate(from_bits):
            part = block[:, block[0] == turn]
            if part.shape[1] < 2:
                continue
            keys, rotated, fps = part[1:4], part[4].view(np.uint64), part[5]
            group = np.cumsum(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            label = trie_links(group, rotated, max_bits, from_bit)
            order = np.lexsort((fps, label))
            label, fps = label[order], fps[order]
            new = np.r_[True, label[1:] != label[:-1]]
            root = fps[np.flatnonzero(new)][np.cumsum(new) - 1]
            some = root != fps
            yield pa.RecordBatch.from_arrays([pa.array(root[some]), pa.array(fps[some])], ["u", "v"])

    rest = np.zeros((6, 0), np.int64)
    for batch in batches:
        rest = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
        if rest.shape[1] >= WALK_ROWS:  # keep the last group back, it may go on
            end = np.flatnonzero((rest[:4, 1:] != rest[:4, :-1]).any(axis=0))
            if len(end):
                yield from walk(rest[:, : end[-1] + 1])
                rest = rest[:, end[-1] + 1 :]
    yield from walk(rest)


def spanning_links(fps: DataFrame, max_bits: int, group_rows: int) -> DataFrame:
    """``fps(fp)`` distinct -> links ``(u, v)`` that connect exactly the
    fingerprints within ``max_bits`` bits (and chains of them)."""
    blocks = max_bits + 1
    widths = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    turns, at = [], 0
    for i, w in enumerate(widths):
        fp = F.col("fp")
        rotated = fp if at == 0 else F.shiftleft(fp, at).bitwiseOR(F.shiftrightunsigned(fp, 64 - at))
        turns.append(F.struct(F.lit(i).cast("long").alias("turn"), F.shiftrightunsigned(rotated, 64 - w).alias("block"),
                              rotated.alias("rotated")))
        at += w
    keyed = fps.select("fp", F.explode(F.array(*turns)).alias("t")).select("t.*", "fp")
    big = (keyed.groupBy("turn", "block").count().filter(F.col("count") > group_rows)
           .select("turn", "block", F.ceil(F.col("count") / group_rows).cast("long").alias("chunks")))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    dealt = (keyed.join(big, ["turn", "block"], "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long"))).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select("turn", "block", F.least("mine", "other").alias("c1"), F.greatest("mine", "other").alias("c2"),
                     "rotated", "fp"))
    # unsigned order of the rotated bits, as the trie has it
    key = ["turn", "block", "c1", "c2"]
    sorted_ = dealt.repartition(*key).sortWithinPartitions(*key, F.col("rotated") < 0, "rotated")
    return sorted_.mapInArrow(lambda it: _spanning(it, max_bits, widths), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4,
                    max_bits: int = 4, group_rows: int = 1 << 16) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (long), ``component_id``
    (the smallest id reachable over links, the own one included)."""
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"),
                                   fingerprint_column(text_col, words_per_shingle).alias("fp")), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("low"))
    links = spanning_links(distinct.select("fp"), max_bits, group_rows)
    found = connected_components(links)
    rooted = cut_lineage(distinct.join(found, distinct.fp == found.node, "left")
                         .select("fp", "low", F.coalesce("root", "fp").alias("root")), "roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = lookup(rooted.select("fp", "root"), lowest, ["root"]).select("fp", "component_id")
    return lookup(rows, named, ["fp"]).select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (a
    null id comes last), at equal ids the one with the smallest content hash (128 bits
    over all columns but maps and variants, nulls told from their absence)."""
    content = spare(docs.columns, "_content")
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    marks = [c.isNull() for c in hashed]  # a hash passes over nulls, so their places count as well
    marked = docs.withColumn(content, F.struct(F.xxhash64(*hashed, *marks).alias("a"), F.xxhash64(*marks, *hashed[::-1]).alias("b")))
    own = F.col(f"`{id_col}`")
    near = near_duplicates(marked.select(
        F.struct(own.isNull().alias("none"), own.alias("id"), F.col(content).alias("content")).alias("row"),
        F.col(f"`{text_col}`").alias("text")), "row", "text", **how)
    stay = near.select("component_id").distinct().select("component_id.id", "component_id.content").alias("_s")
    kept = marked.alias("_d").join(stay, F.col(f"_d.`{id_col}`").eqNullSafe(F.col("_s.id"))
                                   & (F.col(f"_d.{content}") == F.col("_s.content")), "left_semi")
    # exact repeats of a row share its id and content: one of them stays
    return kept.dropDuplicates([id_col, content]).drop(content)

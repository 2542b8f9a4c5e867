"""Trie of conversation prefixes by vertical bitmaps.

Conversations that begin with the same turns share a path; a node is one distinct
sequence of first turns. An index maps (position, turn) to the bitset of the
conversations that have this turn there. The walk goes depth first: a node's bitset,
intersected with the postings of the next position, gives its children; popcounts
give member numbers, the lowest bit the smallest member, and the members that end
there the end list.

Shards and bands: a shard is a range of ``2 ** SHARD_BITS`` conversation ids, so it
holds a bounded number of conversations and its end lists are contiguous pieces of
the whole ones; conversations longer than ``BAND`` turns are cut into bands of
positions, each walked by a task of its own from the prefixes at its start. A node's
name is the XOR of 128-bit hashes of its (position, turn) items, so shards and bands
name equal prefixes equally and their nodes are merged by name. Positions come from
row numbers inside short ranges of turn numbers and offsets of those ranges: neither
a long conversation nor a common first turn is one task's work.

Sums over subtrees need no walk up the tree. A conversation ``c`` is the smallest
member of the nodes on the lower part of its own path, from one node on. With
``total(c)`` the code points of its turns, ``own(c)`` those from that node on and
``leaf(c)`` 1 if its last node is a childless one, a node's distinct turns below it
count ``sum own`` and its leaves ``sum leaf`` over its members (less what its own
smallest member has above it), and ``sum total`` tells the turns below it with
repeats. The three are added up from the bitsets in a second walk. End lists are
hashed as a stream of the shards' pieces in order, never held whole.

Edge cases: rows with a null conversation id are left out; null role or text is
empty; a null turn comes first; rows of one turn number are in order of their content
hash, repeated rows are turns of their own; texts count whole; an empty table gives
no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.llm.common import lookup
from labelkiln.session import cut_lineage

#: Conversation ids of a shard (a power of two), turns of a band, turn numbers of a numbering range (a power of two).
SHARD_BITS, BAND, RANGE_BITS = 10, 64, 6
#: Numbers of a node's row, and of a row of the walk's input.
NODE = "k1 long, k2 long, p1 long, p2 long, depth long, shard long, n long, conv long, chars long, above long, total long, ends string"
SUMS = "k1 long, k2 long, depth long, conv long, own_above long, own long, leaf long"
NAME = ["k1", "k2", "depth"]


def _before(*keys: str, order: list) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def number_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 1), ``h1``, ``h2`` (hash of role and text), ``chars``."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.length(text).cast("long").alias("chars"))
    rows = cut_lineage(rows.withColumn("part", F.shiftright("turn", RANGE_BITS)), "turns")
    parts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    offsets = parts.select("conv", F.col("part").alias("part_"), F.coalesce(
        F.sum("n").over(_before("conv", order=[F.asc_nulls_first("part")])), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy(F.asc_nulls_first("turn"), "h1", "h2"))
    placed = rows.withColumn("inside", inside).alias("r").join(
        offsets.alias("o"), (F.col("r.conv") == F.col("o.conv")) & F.col("part").eqNullSafe(F.col("part_")))
    return placed.select("r.conv", (F.col("inside") + F.col("offset")).alias("pos"), "h1", "h2", "chars")


def graft(turns: DataFrame, donor: Column, first: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Each conversation with its first ``first`` turns (``most`` at most) replaced by
    as many of conversation ``donor``'s (both over ``conv``): new turns, and all
    conversations as ``(conv)``, the turnless ones included."""
    turns = cut_lineage(turns, "numbered")
    convs = turns.select("conv").distinct().select("conv", donor.alias("donor"), first.cast("long").alias("first"))
    head = turns.filter(F.col("pos") <= most).withColumnRenamed("conv", "donor")
    given = convs.join(head, "donor").filter("pos <= first").select("conv", "pos", "h1", "h2", "chars")
    taken = given.groupBy("conv").agg(F.count("*").alias("taken"))
    shift = convs.join(taken, "conv", "left").select("conv", "first", F.coalesce("taken", F.lit(0)).alias("taken"))
    # first and donor depend on the conversation id alone, so a long conversation needs the small table's row only
    rest = lookup(turns.filter(F.col("pos") > first), shift, ["conv"]).select(
        "conv", (F.col("pos") - F.col("first") + F.col("taken")).alias("pos"), "h1", "h2", "chars")
    return given.unionByName(rest), convs.select("conv")


class _Shard:
    """The bitmap index of one shard and band, and its walk."""

    def __init__(self, rows: pa.Table):
        heads = rows.column("pos").to_numpy() == 0
        head = {c: rows.column(c).to_numpy()[heads] for c in rows.column_names}
        order = np.argsort(head["conv"])
        self.convs = head["conv"][order]
        self.head = {c: v[order] for c, v in head.items()}
        self.band, self.shard = int(head["band"][0]), int(head["shard"][0])
        conv, pos, a, b, chars = (rows.column(c).to_numpy()[~heads] for c in ("conv", "pos", "a", "b", "chars"))
        self.item: list[dict[int, tuple[int, int, int]]] = [{} for _ in self.convs]
        self.postings: dict[tuple[int, int, int], int] = {}
        self.chars: dict[tuple[int, int, int], int] = {}
        for i, *key, c in zip(np.searchsorted(self.convs, conv).tolist(), pos.tolist(), a.tolist(), b.tolist(), chars.tolist()):
            key = tuple(key)
            self.item[i][key[0]] = key
            self.postings[key] = self.postings.get(key, 0) | 1 << i
            self.chars[key] = c
        self.ends: dict[int, int] = {}
        for i, n in enumerate(self.head["turns"].tolist()):
            self.ends[n] = self.ends.get(n, 0) | 1 << i

    def members(self, bits: int) -> np.ndarray:
        raw = np.frombuffer(bits.to_bytes(len(self.convs) // 8 + 1, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little"))

    def walk(self) -> Iterator[tuple]:
        """Nodes of the band: (name, parent's name, depth, bitset, ends, chars, chars above)."""
        starts: dict[tuple[int, int], int] = {}
        above: dict[tuple[int, int], int] = {}
        for i, (a, b, c) in enumerate(zip(*(self.head[x].tolist() for x in ("a", "b", "chars")))):
            starts[a, b] = starts.get((a, b), 0) | 1 << i
            above[a, b] = c
        first, last = self.band * BAND, (self.band + 1) * BAND
        stack = [(name, None, first, bits, 0, above[name]) for name, bits in starts.items()]
        while stack:
            name, parent, depth, bits, chars, over = stack.pop()
            ended = bits & self.ends.get(depth, 0)
            if depth > first or self.band == 0:  # a band's start is the last node of the band before
                yield name, parent or (0, 0), depth, bits, ended, chars, over
            rest = bits ^ ended if depth < last else 0
            while rest:
                low = (rest & -rest).bit_length() - 1
                item = self.item[low][depth + 1]
                child = rest & self.postings[item]
                rest ^= child
                stack.append(((name[0] ^ item[1], name[1] ^ item[2]), name, depth + 1, child, self.chars[item], over + chars))


def _nodes(rows: pa.Table) -> pa.Table:
    shard, out = _Shard(rows), []
    totals = shard.head["total"]
    for name, parent, depth, bits, ended, chars, over in shard.walk():
        who = shard.members(bits)
        told = ",".join(map(str, shard.convs[shard.members(ended)].tolist())) if ended else None
        out.append((*name, *parent, depth, shard.shard, bits.bit_count(), shard.convs[who[0]], chars, over, totals[who].sum(), told))
    return _table(out, NODE)


def _sums(rows: pa.Table) -> pa.Table:
    shard, out = _Shard(rows), []
    own, leaf, own_above = (shard.head[c] for c in ("own", "leaf", "own_above"))
    for name, _, depth, bits, *_ in shard.walk():
        who = shard.members(bits)
        out.append((*name, depth, shard.convs[who[0]], own_above[who[0]], own[who].sum(), leaf[who].sum()))
    return _table(out, SUMS)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.Table.from_arrays([pa.array([v if t == "string" else int(v) for v in c], kinds[t])
                                 for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, shard, piece) rows -> one SHA-256 per name, piece by piece."""
    name, state = None, None
    for batch in batches:
        out = []
        for *key, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key == name:
                state.update(b"," + piece.encode())
            else:
                if state:
                    out.append((*name, state.hexdigest()))
                name, state = key, hashlib.sha256(piece.encode())
        yield from _table(out, "k1 long, k2 long, depth long, ends_sha256 string").to_batches()
    if state:
        yield from _table([(*name, state.hexdigest())], "k1 long, k2 long, depth long, ends_sha256 string").to_batches()


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``turns(conv, pos, h1, h2, chars)``, positions from 1 without gaps, and all
    conversations ``(conv)`` -> one row per node: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    shard, zero = F.shiftright("conv", SHARD_BITS), F.lit(0).cast("long")
    items = cut_lineage(turns.select(
        shard.alias("shard"), F.floor((F.col("pos") - 1) / BAND).alias("band"), "conv", "pos",
        F.xxhash64("pos", "h1", "h2").alias("a"), F.xxhash64("h2", "h1", "pos").alias("b"), "chars"), "items")
    bands = items.groupBy("conv", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
                                              F.sum("chars").alias("chars"), F.count("*").alias("n"))
    so_far = _before("conv", order=["band"])
    all_of = bands.groupBy("conv").agg(F.sum("n").alias("turns"), F.sum("chars").alias("total"))
    starts = bands.select("conv", "band", *[F.coalesce(f(c).over(so_far), zero).alias(c)
                                            for f, c in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "chars"))])
    heads = cut_lineage(convs.join(all_of, "conv", "left").join(starts, "conv", "left").select(
        shard.alias("shard"), F.coalesce("band", zero).alias("band"), "conv", zero.alias("pos"),
        *[F.coalesce(c, zero).alias(c) for c in ("a", "b", "chars", "turns", "total")]), "heads")
    local = cut_lineage(heads.unionByName(items, allowMissingColumns=True).fillna(0, ["turns", "total"])
                        .groupBy("shard", "band").applyInArrow(_nodes, NODE), "shard-nodes")

    merged = local.groupBy(*NAME).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        F.first("chars").alias("chars"), F.first("above").alias("above"), F.sum("total").alias("total"))
    merged = cut_lineage(merged, "nodes")
    kids = merged.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    nodes = cut_lineage(merged.join(kids, NAME, "left").fillna(0, ["n_children"]), "nodes")

    firsts = nodes.groupBy("conv").agg(F.min(F.struct("depth", "above")).alias("f"),
                                       F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    weighed = heads.join(firsts.select("conv", F.col("f.above").alias("own_above"), "leaf"), "conv", "left").withColumn(
        "own", F.when(F.col("own_above").isNull(), 0).otherwise(F.col("total") - F.col("own_above")))
    weights = ["turns", "total", "own", "leaf", "own_above"]
    sums = (weighed.unionByName(items, allowMissingColumns=True).fillna(0, weights)
            .groupBy("shard", "band").applyInArrow(_sums, SUMS).groupBy(*NAME)
            .agg(F.min(F.struct("conv", "own_above")).alias("f"), F.sum("own").alias("own"), F.sum("leaf").alias("n_leaves")))

    pieces = local.filter("ends IS NOT NULL").select(*NAME, "shard", "ends")
    ends = pieces.repartition(*NAME).sortWithinPartitions(*NAME, "shard").mapInArrow(
        _hash_ends, "k1 long, k2 long, depth long, ends_sha256 string")
    parents = nodes.filter("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                                                    F.col("conv").alias("parent_conv_id"))
    placed = lookup(nodes, parents, ["p1", "p2", "depth"])
    whole = placed.join(sums, NAME).join(ends, NAME, "left")
    below = F.col("total") - F.col("n") * F.col("above")
    distinct = F.col("own") - (F.col("above") - F.col("f.own_above"))
    return whole.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
                        "n_leaves", (below - distinct).alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

"""Mixing sources to target weights by capped water-filling.

Every source wants ``weight / sum(weights)`` of the total words. A source whose
share exceeds ``max_epochs`` times its own words is clamped there, and the excess
goes to the others in proportion to their weights, round by round until no
source is above its cap. A source's documents are then repeated whole
``floor(target / size)`` times, and a seeded part of them once more: documents in the
order of a keyed hash as long as they fit; then the same over the remaining ones that
fit the words still missing, pass by pass until none fits. Where it ends nearer to the
target, the shortest document left is taken too, and taken ones are given back in the
same way until none fits the words too many. Every row is a document of its own,
whatever its id.

The decision of a document depends only on its source's row of the plan and its own
size and hash, so texts are never shuffled. Rows that are equal in every column are
taken next to each other; a pass may end inside such a group, which is then named in
the plan (at most one group a pass and one more), and of its rows the first
``k`` are taken, numbered by partition. Prefix sums over a source run in hash buckets
(bucket totals, then within a bucket), so a source that holds a third of all rows is
spread over ``16 ** BUCKET_DIGITS`` windows. Everything is DataFrame operations; the
driver sees one number per water-filling round and one row per pass.

Edge cases: null text has size 0; a null source is a source of its own, ordered
last; a source without words has target 0 and nothing is taken; the same inputs and
seed give the same result in any partitioning (of rows equal in every column any may
be the taken ones); an empty table gives no rows; no document left out fits the words a
source still misses. Columns of a map type take no part in the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.llm.common import spare, word_count
from labelkiln.session import cut_lineage

#: Hex digits of the hash that name a bucket of the prefix sums.
BUCKET_DIGITS = 3
#: Copies of one row made by one row of a task.
CHUNK = 4096

KEY = ["none", "src"]
STEPS = "array<struct<most:double,cut:string>>"
PARTS = "array<struct<h:string,k:bigint,n:bigint>>"


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``sizes(none, src, size)`` with ``rank`` from 0 by code point, null last.
    Range partitions are counted and offset, so no task sorts all sources."""
    order = [F.col("none"), F.col("src")]
    ranged = cut_lineage(sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))  # at most one row per shuffle partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (ranged.withColumn("inside", inside).join(offsets, "part")
            .select("none", "src", "size", (F.col("offset") + F.col("inside") - 1).alias("rank")))


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """``sources(size, weight, ...)`` with ``target`` (double). The level is the
    target per unit of weight; sources whose share at a level is above their cap
    are clamped, and the next level spreads what they leave over the others."""
    cap, total, level = F.col("size") * max_epochs, None, 0.0
    while True:
        clamped = F.col("weight") * F.lit(level) > cap
        got = sources.agg(F.sum("size").alias("total"), F.sum(F.when(clamped, cap)).alias("held"),
                          F.sum(F.when(~clamped, F.col("weight"))).alias("weight")).first()
        total = got["total"] or 0
        if not got["weight"]:  # everything is clamped
            break
        rise = float(total - (got["held"] or 0)) / float(got["weight"])
        if rise <= level:
            break
        level = rise
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(share > cap, cap.cast("double")).otherwise(share))


def content_hash(docs: DataFrame, seed: int) -> Column:
    """The order in which single rows are drawn (32 hex digits): a keyed hash of the
    whole row, equal only for rows that are equal in every column, nulls included."""
    cols = [F.col(f"`{c}`").cast("string") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.md5(F.coalesce(F.concat(F.lit("="), c), F.lit("null"))) for c in cols]))


def running_sums(units: DataFrame, words: Column) -> DataFrame:
    """``units`` with ``sum``: the ``words`` of a source's units up to each one in
    the order of ``h``."""
    units = units.withColumn("words", words).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    totals = units.groupBy(*KEY, "bucket").agg(F.sum("words").alias("words"))
    below = Window.partitionBy(*KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*KEY, "bucket", F.coalesce(F.sum("words").over(below), F.lit(0)).alias("offset"))
    upto = Window.partitionBy(*KEY, "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    return (units.withColumn("inside", F.sum("words").over(upto)).join(offsets, [*KEY, "bucket"])
            .withColumn("sum", F.col("offset") + F.col("inside")).drop("bucket", "words", "offset", "inside"))


def passes(units: DataFrame, state: DataFrame) -> DataFrame:
    """``state(none, src, gap, ...)`` with ``steps`` and ``parts`` of passes over
    ``units`` until none fits a source's gap, and the ``gap`` left. Each pass takes
    at least one row of every source that still has a fitting one, so they end."""
    others = [c for c in state.columns if c not in (*KEY, "gap")]
    state = cut_lineage(state.withColumn("steps", F.expr(f"cast(array() as {STEPS})"))
                        .withColumn("parts", F.expr(f"cast(array() as {PARTS})")), "fill")
    left = units
    while True:
        fitting = left.join(state.select(*KEY, "gap"), KEY).filter("size <= gap")
        running = cut_lineage(running_sums(fitting, F.col("size") * F.col("n")), "running")
        if running.isEmpty():
            return state
        fits = F.col("sum") <= F.col("gap")
        cuts = running.groupBy(*KEY).agg(
            F.max(F.when(fits, F.col("h"))).alias("cut"), F.coalesce(F.max(F.when(fits, F.col("sum"))), F.lit(0)).alias("filled"),
            F.min(F.when(~fits, F.struct("h", "size", "n"))).alias("next"))
        k = F.coalesce(F.floor((F.col("gap") - F.col("filled")) / F.col("next.size")), F.lit(0)).cast("long")
        done = state.join(cuts, KEY, "left").withColumn("k", k)
        step = F.struct(F.col("gap").alias("most"), F.col("cut"))
        part = F.struct(F.col("next.h").alias("h"), F.col("k"), F.col("next.n").alias("n"))
        state = cut_lineage(done.select(
            *KEY, *others,
            F.when(F.col("cut").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(step))).alias("steps"),
            F.when(F.col("k") > 0, F.concat("parts", F.array(part))).otherwise(F.col("parts")).alias("parts"),
            (F.col("gap") - F.coalesce("filled", F.lit(0)) - F.col("k") * F.coalesce("next.size", F.lit(0))).alias("gap")), "fill")
        left = running.filter(~fits).select(*KEY, "h", "size", "n")


def whole_fill(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``steps``, ``drops`` and ``parts``: rows taken until none
    fits; then, where that ends nearer to the target, the shortest row left is taken
    too and others are given back until none fits the words too many."""
    units = cut_lineage(rows.filter("size > 0").groupBy(*KEY, "h").agg(
        F.first("size").alias("size"), F.count("*").alias("n")), "units")
    filled = passes(units, targets.withColumn("gap", F.col("goal")))
    known = units.join(filled.select(*KEY, "steps", "parts"), KEY)
    taken = _by_step(F.col("size"), F.col("h"), F.col("steps"))
    rest = known.filter(~taken).groupBy(*KEY).agg(F.min(F.struct("size", "h", "n")).alias("best"))
    over = (filled.select(*KEY, F.col("gap").alias("short")).join(rest, KEY)
            .withColumn("gap", F.col("best.size") - F.col("short")))
    back = passes(known.filter(taken).select(*KEY, "h", "size", "n"), over)
    better = back.filter("gap < short").select(*KEY, "best", F.col("steps").alias("given"), F.col("parts").alias("some"))
    same = F.filter("parts", lambda p: p["h"] == F.col("best.h"))
    more = F.coalesce(F.get(same, F.lit(0))["k"], F.lit(0)) + 1
    best = F.struct(F.col("best.h").alias("h"), more.cast("long").alias("k"), F.col("best.n").alias("n"))
    others = F.filter("parts", lambda p: p["h"] != F.col("best.h"))
    less = F.transform("some", lambda p: F.struct(p["h"].alias("h"), (p["n"] - p["k"]).alias("k"), p["n"].alias("n")))
    kept = F.col("best").isNull()
    return (filled.join(better, KEY, "left")
            .withColumn("drops", F.when(kept, F.expr(f"cast(array() as {STEPS})")).otherwise(F.col("given")))
            .withColumn("parts", F.when(kept, F.col("parts")).otherwise(F.concat(others, F.array(best), less)))
            .drop("best", "given", "some", "gap"))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """``(rows, plan)``: ``rows(id, none, src, size, h, at)`` per document, and
    ``plan(none, src, source_size, target, whole, steps, drops, parts)`` per
    source. A document is taken ``whole`` times, and once more if for one of ``steps``
    and none of ``drops`` its size is at most ``most`` and its hash at most ``cut``; of
    the ``n`` rows of a hash in ``parts`` the first ``k`` are. Weights repeat in the
    order of the sources."""
    rows = cut_lineage(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").isNull().alias("none"),
        F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("src"), word_count(F.col(f"`{text_col}`")).alias("size"),
        content_hash(docs, seed).alias("h"), F.monotonically_increasing_id().alias("at")), "sizes")
    sizes = rows.groupBy(*KEY).agg(F.sum("size").alias("size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    weighted = cut_lineage(ranked_sources(sizes).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))), "weights")
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long")
    targets = (water_fill(weighted, max_epochs).withColumn("whole", whole)
               .select(*KEY, F.col("size").alias("source_size"), "target", "whole",
                       (F.col("target") - F.col("whole") * F.col("size")).alias("goal")))
    return rows, cut_lineage(whole_fill(rows, targets).drop("goal"), "plan")


def _by_step(size: Column, h: Column, steps: Column) -> Column:
    return F.coalesce(F.exists(steps, lambda s: (size <= s["most"]) & (h <= s["cut"])), F.lit(False))


def _taken(size: Column, h: Column, steps: Column, drops: Column, parts: Column) -> Column:
    """True for rows taken once more; not for the groups of which only some are."""
    here = F.coalesce(F.exists(parts, lambda p: h == p["h"]), F.lit(False))
    all_of_it = F.coalesce(F.exists(parts, lambda p: (h == p["h"]) & (p["k"] >= p["n"])), F.lit(False))
    return F.when(here, all_of_it).otherwise(_by_step(size, h, steps) & ~_by_step(size, h, drops))


def copies(size: Column, h: Column, plan: str) -> Column:
    """How often the mix takes a document whose source's row of ``plan`` (an
    alias) is joined to it, without the rows of split groups taken once more."""
    of = {c: F.col(f"{plan}.{c}") for c in ("steps", "drops", "parts", "whole", "source_size")}
    more = _taken(size, h, of["steps"], of["drops"], of["parts"]).cast("long")
    return F.when(of["source_size"] > 0, of["whole"] + more).otherwise(0).cast("long")


def split_groups(plan: DataFrame) -> DataFrame | None:
    """``(none, src, h, k)`` of the groups of equal rows of which only ``k`` are
    taken once more; None without any."""
    groups = (plan.select(*KEY, F.explode("parts").alias("p")).filter("p.k < p.n")
              .select(*KEY, F.col("p.h").alias("h"), F.col("p.k").alias("k")))
    return None if groups.isEmpty() else groups


def numbered(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``groups`` with ``k`` and their number ``no`` in the group, from 1.
    A window holds one partition's rows of a group, or one count per partition."""
    rows = rows.join(groups, [*KEY, "h"]).withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy(*KEY, "h", "part").agg(F.count("*").alias("c"))
    below = Window.partitionBy(*KEY, "h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*KEY, "h", "part", F.coalesce(F.sum("c").over(below), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(*KEY, "h", "part").orderBy("at"))
    return (rows.withColumn("inside", inside).join(offsets, [*KEY, "h", "part"])
            .withColumn("no", F.col("offset") + F.col("inside")))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per document: ``id_col``, ``size``, ``source_size``, ``target``
    (its source's) and ``taken`` (words the mix takes of it)."""
    rows, plan = mixing_plan(docs, id_col=id_col, **how)
    groups = split_groups(plan)
    rows = rows.withColumn("more", F.lit(0))
    if groups is not None:
        some = numbered(rows, groups).withColumn("more", (F.col("no") <= F.col("k")).cast("int")).select(*rows.columns)
        rows = rows.join(groups, [*KEY, "h"], "left_anti").select(*rows.columns).union(some)
    joined = rows.join(plan.alias("p"), KEY)
    times = copies(F.col("size"), F.col("h"), "p") + F.col("more")
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, text_col: str = "text",
        **how) -> DataFrame:
    """The mixed documents: ``docs`` with each row repeated as often as it is taken."""
    _, plan = mixing_plan(docs, id_col=id_col, source_col=source_col, seed=seed, text_col=text_col, **how)
    h, one = spare(docs.columns, "_h"), spare(docs.columns, "_one")
    d = docs.withColumn(h, content_hash(docs, seed)).alias("_docs")
    source, hashed = F.col(f"_docs.`{source_col}`"), F.col(f"_docs.{h}")
    same = lambda p: (source.isNull() == F.col(f"{p}.none")) & (F.coalesce(source, F.lit("")) == F.col(f"{p}.src"))
    joined = d.join(plan.alias("_plan"), same("_plan"))
    times = copies(word_count(F.col(f"_docs.`{text_col}`")), hashed, "_plan").cast("int")
    columns = [F.col(f"_docs.`{c}`") for c in docs.columns]
    mixed = joined.select(*columns, F.explode(F.array_repeat(F.lit(1), times)).alias(one)).drop(one)
    groups = split_groups(plan)
    if groups is None:
        return mixed
    # rows of a group are equal in every column: one of them k times, CHUNK rows a task's row
    hits = d.join(groups.alias("_g"), same("_g") & (hashed == F.col("_g.h")))
    firsts = hits.groupBy("_g.none", "_g.src", "_g.h", "_g.k").agg(F.first(F.struct(*columns)).alias("row"))
    chunks = firsts.select("row", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("k") - 1) / CHUNK))).alias("c"))
    n = F.least(F.lit(CHUNK), F.col("k") - F.col("c") * CHUNK).cast("int")
    some = chunks.repartition("c").select("row", F.explode(F.array_repeat(F.lit(1), n)).alias("_1")).select(
        *[F.col(f"row.`{c}`") for c in docs.columns])
    return mixed.union(some)

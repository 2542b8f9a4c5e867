"""Quoted CSV read in many tasks, quoted newlines included.

Spark's multi-line CSV reader gives each file to one task, because a newline at a
split's edge may lie inside quotes. Here files are read as physical lines in ordinary
splits, and each split is summed up for both cases, "begins outside quotes" and
"begins inside": the parity of its quotes, and how many records start in it. A prefix
scan over the splits' parities (one small row per split) tells which case holds, and
with it the number of the first record of each split. Then each task parses the records
that lie whole in its split; the few that cross a split's edge are put together from
their lines by record number.

Doubled quotes inside a quoted field leave the parity as it is, so any RFC-4180 file is
read exactly. A stray quote in an unquoted field is an error, as is a record with
another number of fields than the header, or one whose quotes never end.
"""

from __future__ import annotations

import csv
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from labelkiln.session import cut_lineage

SPLIT = ["file", "block"]
SUMMARY = ("file string, block long, lines long, parity int, starts_out long, starts_in long, closes long, "
           "last_out long, last_in long, first long")


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, id, value``: the lines between newlines, a split's in order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("id"), "value")


class SplitSummary:
    """What a run of lines means for the records, whichever way it begins."""

    def __init__(self, first: int = 0):
        self.first, self.lines, self.parity = first, 0, 0
        self.starts, self.last = [0, 0], [-1, -1]  # if it begins outside, inside quotes
        self.closes = -1  # lines up to the first one that changes the state, that one included

    def add(self, odd: np.ndarray, blank: np.ndarray) -> None:
        """More lines: whether each holds an odd number of quotes, and whether it is empty."""
        before = (np.cumsum(odd) - odd + self.parity) % 2
        for case in (0, 1):
            begins = np.flatnonzero((before == case) & ~blank)  # an empty line outside quotes is no record
            self.starts[case] += len(begins)
            if len(begins):
                self.last[case] = self.lines + int(begins[-1])
        if self.closes < 0 and odd.any():
            self.closes = self.lines + int(np.flatnonzero(odd)[0]) + 1
        self.parity = int(self.parity + odd.sum()) % 2
        self.lines += len(odd)

    def row(self) -> tuple:
        closes = self.closes if self.closes >= 0 else self.lines
        return self.lines, self.parity, *self.starts, closes, *self.last, self.first


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, id, odd, blank) in order -> one SUMMARY row per split."""
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    now, held = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*now, *held.row())))], pa.schema(
            [(f.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in SUMMARY.split(", ")]))

    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column(0).dictionary_encode()
        code, block = files.indices.to_numpy(), batch.column(1).to_numpy()
        ids, odd, blank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = files.dictionary[int(code[a])].as_py(), int(block[a])
            if key != now:
                if held:
                    yield told()
                now, held = key, SplitSummary(int(ids[a]))
            held.add(odd[a:b].astype(np.int64), blank[a:b].astype(bool))
    if held:
        yield told()


def split_states(lines: DataFrame, header: bool) -> DataFrame:
    """One row per split: ``file, block, first, inside`` (it begins inside quotes),
    ``ends_inside, closes, opens`` (line at which the last record starts, -1: none does),
    ``record`` (number of its first starting record in the file) and ``base`` (what makes
    a record's number its position over all files, headers not counted)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    summed = cut_lineage(lines.select("file", "block", "id", (quotes % 2).cast("int").alias("odd"),
                                      F.col("value").isin("", "\r").alias("blank")).mapInArrow(_summaries, SUMMARY), "csv-splits")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1
    known = (summed.withColumn("inside", inside)
             .withColumn("ends_inside", F.col("inside") != (F.col("parity") == 1))
             .withColumn("starts", F.when(F.col("inside"), F.col("starts_in")).otherwise(F.col("starts_out")))
             .withColumn("opens", F.when(F.col("inside"), F.col("last_in")).otherwise(F.col("last_out"))))
    placed = known.withColumn("record", F.coalesce(F.sum("starts").over(before), F.lit(0)))
    # one row per file
    files = known.groupBy("file").agg((F.sum("starts") - int(header)).alias("n"),
                                      F.max_by("ends_inside", "block").alias("open"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - int(header)).alias("base"), F.when(
        F.col("open"), F.raise_error(F.concat(F.lit("quotes never end in "), "file"))).alias("broken"))
    return placed.join(offsets, "file").filter("broken IS NULL").select(
        *SPLIT, "first", "inside", "ends_inside", "closes", "opens", "record", "starts", "base")


def records_of(lines: Iterator[str], inside: bool) -> Iterator[str | None]:
    """The records that lie whole in a run of lines. One that began before it, or goes
    on behind it, is passed over (a None stands for the latter)."""
    held: list[str] = []
    skipping = inside
    for line in lines:
        odd = line.count('"') & 1
        if skipping:
            skipping = not odd
            continue
        if held:
            held.append(line)
            if odd:
                yield "\n".join(held)
                held = []
        elif odd:
            held = [line]
        elif line not in ("", "\r"):
            yield line
    if held:
        yield None


def parse(records: list[str], fields: int) -> list[list[str | None]]:
    """Fields of whole records; an empty one is null."""
    out = []
    for row in csv.reader([r[:-1] if r.endswith("\r") else r for r in records], strict=True):
        if len(row) != fields:
            raise ValueError(f"a record has {len(row)} fields, not {fields}: {row[:3]}")
        out.append([f or None for f in row])
    return out


#: Characters of records parsed at a time.
PARSED = 1 << 20


def _some(records: Iterator[str | None]) -> Iterator[list[str]]:
    """Whole records in lists of about ``PARSED`` characters."""
    held, size = [], 0
    for r in records:
        if r is None:
            continue
        held.append(r)
        size += len(r)
        if size >= PARSED:
            yield held
            held, size = [], 0
    if held:
        yield held


def _parse_whole(names: list[str], header: bool):
    """(inside, record, base, value) lines, split by split -> (row_idx, fields). A task
    holds one batch of lines and ``PARSED`` characters of records, not its split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line for b in batches for line in zip(*[b.column(i).to_pylist() for i in range(5)]))
        for (_, inside, record, base), own in itertools.groupby(lines, key=lambda line: line[:4]):
            number = record
            for records in _some(records_of((line[4] for line in own), inside)):
                rows = parse(records, len(names))
                first = int(header and number == 0 and bool(rows))
                if first and [f or "" for f in rows[0]] != names:
                    raise ValueError(f"header {rows[0]}, not {names}")
                numbers = np.arange(len(rows), dtype=np.int64) + number + base
                number += len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(numbers[first:]), pa.array(rows[first:], pa.list_(pa.string()))],
                                                  ["row_idx", "fields"])

    return run


def _crossing(lines: DataFrame, states: DataFrame, header: bool) -> DataFrame:
    """``row_idx, text`` of the records that cross a split's edge."""
    at = F.col("id") - F.col("first")
    head = F.col("inside") & (at < F.col("closes"))
    tail = F.col("ends_inside") & (F.col("opens") >= 0) & (at >= F.col("opens"))
    record = F.when(head, F.col("record") - 1).otherwise(F.col("record") + F.col("starts") - 1)
    parts = (lines.join(F.broadcast(states), SPLIT).filter(head | tail)
             .select("file", record.alias("record"), "base", F.struct("block", "id", "value").alias("part")))
    if header:
        parts = parts.filter("record > 0")
    whole = parts.groupBy("file", "record", "base").agg(F.array_sort(F.collect_list("part")).alias("parts"))  # one record's lines
    return whole.select((F.col("record") + F.col("base")).alias("row_idx"),
                        F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("text"))


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType, names: list[str],
                   header: bool = True) -> DataFrame:
    """The columns of ``schema`` (by name; ``names`` are the file's columns in order) and
    ``row_idx``, the record's position over all files by path. Three scans: quotes,
    whole records, and the lines of records that cross an edge. The states broadcast
    below are one small row per split."""
    lines = physical_lines(spark, path)
    states = cut_lineage(split_states(lines, header), "csv-states")
    known = lines.join(F.broadcast(states), SPLIT).select(
        F.xxhash64("file", "block").alias("split"), "inside", "record", "base", "value")
    whole = known.mapInArrow(_parse_whole(names, header), "row_idx long, fields array<string>")

    def parse_crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = parse(b.column(1).to_pylist(), len(names))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.string()))], ["row_idx", "fields"])

    rows = whole.unionByName(_crossing(lines, states, header).mapInArrow(parse_crossing, "row_idx long, fields array<string>"))
    place = {n: i for i, n in enumerate(names)}

    def typed(field: T.StructField) -> Column:
        return F.get("fields", F.lit(place[field.name])).cast(field.dataType).alias(field.name)

    return rows.select(*[typed(f) for f in schema.fields], "row_idx")

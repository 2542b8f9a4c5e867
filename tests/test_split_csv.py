"""Splittable quoted CSV against Python's csv module, at every cut."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from labelkiln.sources import split_csv as S
from labelkiln.sources.readers import read_csv

SCHEMA = T.StructType([T.StructField("b", T.StringType()), T.StructField("n", T.IntegerType())])


def some_csv(seed, rows, newline="\n", quote_all=False):
    r = random.Random(seed)
    pieces = ["x", "é", '"', "\n", ",", " ", '""', "\n\n", "long " * 5, "", "\r\n"]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=newline, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
    w.writerow(["a", "b", "n"])
    data = [("".join(r.choice(pieces) for _ in range(r.randrange(5))), "".join(r.choice(pieces) for _ in range(r.randrange(6))), i)
            for i in range(rows)]
    w.writerows(data)
    return out.getvalue(), [(b or None, n) for _, b, n in data]


def brute_lines(text):
    lines = text.split("\n")
    return lines[:-1] if lines[-1] == "" else lines


@pytest.mark.parametrize("seed", range(6))
def test_every_cut_into_two_and_many_splits(seed):
    """Summary, prefix scan, whole and crossing records over all cuts of the lines."""
    text, data = some_csv(seed, 12, "\r\n" if seed % 2 else "\n")
    lines = brute_lines(text)
    cuts = [[i] for i in range(len(lines) + 1)] + [sorted(random.Random(k).sample(range(1, len(lines)), 4)) for k in range(20)]
    cuts.append(list(range(1, len(lines))))  # every line a split of its own
    for cut in cuts:
        runs = [lines[a:b] for a, b in zip([0, *cut], [*cut, len(lines)]) if a < b]
        inside, record, got, crossing = False, 0, {}, {}
        for run in runs:
            s = S.SplitSummary()
            for part in (run[:2], run[2:]):  # as batches come
                s.add(np.array([x.count('"') % 2 for x in part], np.int64), np.array([x in ("", "\r") for x in part], bool))
            n, parity, out_, in_, closes, last_out, last_in, _ = s.row()
            starts, opens = (in_, last_in) if inside else (out_, last_out)
            whole = [r for r in S.records_of(iter(run), inside) if r is not None]
            ends = inside != (parity == 1)
            assert len(whole) == starts - (ends and opens >= 0)
            for i, r in enumerate(whole):
                got[record + i] = r
            for i, line in enumerate(run):
                if inside and i < closes:
                    crossing.setdefault(record - 1, []).append(line)
                elif ends and opens >= 0 and i >= opens:
                    crossing.setdefault(record + starts - 1, []).append(line)
            inside, record = ends, record + starts
        assert not inside and not got.keys() & crossing.keys()
        got |= {k: "\n".join(v) for k, v in crossing.items()}
        rows = S.parse([got[k] for k in sorted(got)], 3)
        assert [(b, int(n)) for _, b, n in rows[1:]] == data and rows[0] == ["a", "b", "n"]


@pytest.mark.parametrize("split_bytes,newline,quote_all", [(40, "\n", False), (300, "\r\n", True), (1 << 20, "\n", False)])
def test_reader_with_small_splits(spark, tmp_path, split_bytes, newline, quote_all):
    folder = tmp_path / "parts"
    folder.mkdir()
    want = []
    for k in range(3):
        text, data = some_csv(10 + k, 60, newline, quote_all)
        (folder / f"part-{k}.csv").write_bytes(text.encode())
        want += data
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        lines = S.physical_lines(spark, str(folder))
        if split_bytes == 40:
            assert lines.select("file", "block").distinct().count() > 50  # one file is read in many splits
        got = read_csv(spark, str(folder), SCHEMA).orderBy("row_idx").collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert [r["row_idx"] for r in got] == list(range(len(want)))
    assert [(r["b"], r["n"]) for r in got] == want


def test_broken_files_fail(spark, tmp_path):
    for text in ('a,b,n\n1,"open,2\n', "a,b,n\n1,2\n", 'a,b,n\n1,x"y"z,"q"r\n'):
        path = tmp_path / "broken.csv"
        path.write_text(text)
        with pytest.raises(Exception, match="quotes never end|fields|expected|ValueError|Error"):
            read_csv(spark, str(path), SCHEMA).collect()
    (tmp_path / "other.csv").write_text("a,c\n1,2\n")
    with pytest.raises(ValueError, match="no column b"):
        read_csv(spark, str(tmp_path / "other.csv"), SCHEMA)


def test_blank_lines_header_only_and_empty(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,n\n\n1,"x\n\ny",2\n\n\n3,,4')
    got = read_csv(spark, str(tmp_path / "one.csv"), SCHEMA).orderBy("row_idx").collect()
    assert [tuple(r) for r in got] == [("x\n\ny", 2, 0), (None, 4, 1)]
    (tmp_path / "two.csv").write_text("a,b,n\n")
    assert read_csv(spark, str(tmp_path / "two.csv"), SCHEMA).collect() == []

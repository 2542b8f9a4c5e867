"""A CSV split is parsed in parts of bounded size."""

import pyarrow as pa

from labelkiln.sources import split_csv as SC


def test_a_split_is_parsed_in_parts(monkeypatch):
    monkeypatch.setattr(SC, "PARSED", 20)
    lines = ["x,y"] + [f'{i},"two' + '\n' + f'lines {i}"' for i in range(10)]
    lines = [part for line in lines for part in line.split("\n")]
    cells = [(7, False, 0, -1, line) for line in lines]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("split", "inside", "record", "base", "value"), c)) for c in cells[lo : lo + 4]])
               for lo in range(0, len(cells), 4)]
    got = list(SC._parse_whole(["x", "y"], True)(iter(batches)))
    assert len(got) > 3 and max(b.num_rows for b in got) <= 3
    rows = [(r["row_idx"], *r["fields"]) for b in got for r in b.to_pylist()]
    assert rows == [(i, str(i), f"two\nlines {i}") for i in range(10)]

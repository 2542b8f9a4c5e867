"""Reader edge cases on hand-written task files."""

import os

import pytest

from labelkiln.operators import metrics as M
from labelkiln.sources import readers as R
from labelkiln.sources.tasks import TASKS


def _write(path, lines):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join(lines) + "\n")


def test_tsv_quotes_literal_ragged_rows_and_trailing_empties(spark, tmp_path):
    d = str(tmp_path)
    _write(os.path.join(d, "train.tsv"), [
        "id\tqid1\tqid2\tquestion1\tquestion2\tis_duplicate",
        '7\t1\t2\t"quoted\ttab" stays\tb\t1',      # quote does not swallow the tab
        "8\t1\t2\tshort",                         # fewer than 6 columns: skipped
        "9\t1\t2\ta\t\t0",                        # empty text_b kept
        "10\t1\t2\ta\tb\t",                       # trailing empty label kept as ''
    ])
    _write(os.path.join(d, "dev.tsv"), ["id\tqid1\tqid2\tquestion1\tquestion2\tis_duplicate"])
    rows = {r["guid"]: r for r in R.read_task(spark, TASKS["qqp"], d, "train").collect()}
    assert set(rows) == {"train-7", "train-9", "train-10"}
    assert rows["train-7"]["text_a"] == '"quoted' and rows["train-7"]["text_b"] == 'tab" stays'
    assert rows["train-9"]["text_b"] == "" and rows["train-10"]["label"] == ""
    assert rows["train-9"]["row_idx"] == 3


def test_row_index_follows_file_order_across_files(spark, tmp_path):
    d = str(tmp_path / "parts")
    os.makedirs(d)
    sizes = {"part-0": 5, "part-1": 4000, "part-2": 50}
    expected = []
    for name, n in sizes.items():
        lines = [f"{name}:{i}" for i in range(n)]
        _write(os.path.join(d, name + ".txt"), lines)
        expected += lines
    got = sorted((r["row_idx"], r["value"]) for r in R.read_lines(spark, d).collect())
    assert got == list(enumerate(expected))


def test_cola_has_no_header_and_boolq_skips_first_record(spark, tmp_path):
    d = str(tmp_path)
    _write(os.path.join(d, "train.tsv"), ["src\t1\t\tfirst sentence", "src\t0\t\tsecond"])
    _write(os.path.join(d, "dev.tsv"), ["src\t0\t\tonly"])
    cola = sorted((r["guid"], r["label"]) for r in R.read_task_all(spark, TASKS["cola"], d).collect())
    assert cola == [("dev-0", "0"), ("train-0", "1"), ("train-1", "0")]
    _write(os.path.join(d, "train.jsonl"), [
        '{"idx": 5, "question": "q0", "passage": "p0", "label": true}',
        '{"idx": 6, "question": "q1", "passage": "p1", "label": false}'])
    b = R.read_task(spark, TASKS["boolq"], d, "train").collect()
    assert [(r["guid"], r["text_a"], r["label"]) for r in b] == [("train-6", "q1", "False")]


def test_constant_scores_give_half_auc(spark):
    df = spark.createDataFrame([("a", i % 2, 0.3) for i in range(10)], "g string, y int, p double")
    assert M.roc_auc(df, ["g"]).collect()[0]["roc_auc"] == 0.5


def test_abuse_csv_matches_pandas_semantics(spark, tmp_path):
    import pandas as pd
    texts = ['plain', 'with "quotes" inside', 'comma, separated', 'line one\nline two', '', 'NA', 'null',
             'n/a', 'None', 'nan', 'NaN words are fine', 'tab\there', '"fully quoted"', "x" * 300]
    df = pd.DataFrame({"id": [str(i) for i in range(len(texts))], "comment_text": texts,
                       "threat": 0, "insult": 1, "toxic": 0, "IsAbuse": [i % 2 for i in range(len(texts))]})
    path = str(tmp_path / "cleaned_train.csv")
    df.to_csv(path, index=False)
    ref = pd.read_csv(path).drop(["threat", "insult", "toxic", "id"], axis=1)
    expected = sorted((f"train-{i}", ref.iloc[i]["comment_text"], str(ref.iloc[i]["IsAbuse"]))
                      for i in range(len(ref)) if isinstance(ref.iloc[i]["comment_text"], str))
    got = sorted((r["guid"], r["text_a"], r["label"])
                 for r in R.csv_examples(spark, path, TASKS["abuse"], "train").collect())
    assert got == expected


def test_registered_task_with_its_own_reader(spark, tmp_path):
    from pyspark.sql import functions as F
    from labelkiln.sources import tasks as T

    def pipe_reader(spark, path, set_type):
        rows = R.read_lines(spark, path).select("row_idx", F.split("value", r"\|").alias("c"))
        return rows.select(F.lit(set_type).alias("set_type"), "row_idx",
                           F.concat(F.lit(set_type + "-"), F.col("row_idx").cast("string")).alias("guid"),
                           F.get("c", 0).alias("text_a"), F.lit(None).cast("string").alias("text_b"),
                           F.get("c", 1).alias("label"))

    spec = T.TaskSpec("pipes", "custom", "train.txt", "dev.txt", "dev", 0, "row", None, 0, None, 1, ("n", "y"),
                      reader=pipe_reader)
    T.register_task(spec)
    try:
        _write(os.path.join(str(tmp_path), "train.txt"), ["good|y", "bad|n"])
        got = [(r["guid"], r["text_a"], r["label"]) for r in
               R.read_task(spark, T.get_task("pipes"), str(tmp_path), "train").orderBy("row_idx").collect()]
        assert got == [("train-0", "good", "y"), ("train-1", "bad", "n")]
    finally:
        del T.TASKS["pipes"]


def test_single_line_csv_splits_and_keeps_row_positions(spark, tmp_path):
    import pandas as pd
    n = 3000
    df = pd.DataFrame({"id": [str(i) for i in range(n)],
                       "comment_text": ["NA" if i % 97 == 0 else f"text, number {i} " + "y" * (i % 40) for i in range(n)],
                       "threat": 0, "insult": 0, "toxic": 0, "IsAbuse": [i % 2 for i in range(n)]})
    path = str(tmp_path / "big.csv")
    df.to_csv(path, index=False)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        ex = R.csv_examples(spark, path, TASKS["abuse"], "train", multi_line=False)
        assert R.read_csv(spark, path, R.ABUSE_SCHEMA, multi_line=False).rdd.getNumPartitions() > 1
        got = sorted((r["row_idx"], r["text_a"]) for r in ex.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, t) for i, t in enumerate(df["comment_text"]) if t != "NA"]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    _write(path, ["id,comment_text,IsAbuse,threat,insult,toxic", "7,hello,1,0,0,0"])
    got = R.csv_examples(spark, path, TASKS["abuse"], "train").collect()
    assert [(r["text_a"], r["label"]) for r in got] == [("hello", "1")]
    _write(path, ["id,comment_text,threat", "7,hello,1"])
    with pytest.raises(ValueError, match="IsAbuse"):
        R.csv_examples(spark, path, TASKS["abuse"], "train")


def test_short_rows_fail_or_go_to_the_quarantine(spark, tmp_path):
    path = str(tmp_path / "t.tsv")
    _write(path, ["h\th\th\th\th", "1\ta", "0\t1\t2\tx\ty"])
    rows = R.read_tsv(spark, path)
    with pytest.raises(Exception, match="short row 1"):
        R.tsv_examples(rows, TASKS["mrpc"], "train").collect()
    kept = R.tsv_examples(rows, TASKS["mrpc"], "train", on_short="quarantine").collect()
    assert [(r["text_a"], r["text_b"]) for r in kept] == [("x", "y")]
    assert [(r["row_idx"], r["n_cols"]) for r in R.tsv_quarantine(rows, TASKS["mrpc"]).collect()] == [(1, 2)]


def test_broken_json_fails_or_goes_to_the_quarantine(spark, tmp_path):
    path = str(tmp_path / "t.jsonl")
    good = '{"idx": 1, "question": "q", "passage": "p", "label": true}'
    _write(path, [good, "not json", '{"idx": 3}', good])
    lines = R.read_lines(spark, path)
    with pytest.raises(Exception, match="broken line"):
        R.jsonl_examples(lines, TASKS["boolq"], "train").collect()
    kept = R.jsonl_examples(lines, TASKS["boolq"], "train", on_broken="quarantine").collect()
    assert [(r["row_idx"], r["text_a"], r["label"]) for r in kept] == [(3, "q", "True")]
    assert sorted(r["row_idx"] for r in R.jsonl_quarantine(lines, TASKS["boolq"]).collect()) == [1, 2]

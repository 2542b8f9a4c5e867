"""Task files written from the given tables, for end-to-end reader checks.

Rows come from the test tables by fixed rules:
* pair tasks: a user turn with the assistant turn that follows it in the same
  conversation (pair_id = conv_id * 1_000_000 + turn); class = conv_id mod #classes;
  sts-b score = turn mod 6; qqp rows of conversations with conv_id mod 7 = 0 are
  written short (4 columns); qnli rows with conv_id mod 17 = 0 carry a label
  outside the label list.
* single-text tasks: the labelled comment table, label = toxic (abuse: all four
  labels; empty text where doc_id mod 11 = 0, the text "NA" where doc_id mod 13 = 0).
* part: pairs by hash52('split:' || conv_id || ':' || turn) mod 10 < 8 -> train;
  comments by their split (train -> train, val/test -> dev).

Each file is written as a folder of part files range-partitioned by the row key
(part names sort in key order), so no single task writes the whole file; the
header, when the format has one, is the first line of the first part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelkiln.functions.columns import hash52
from labelkiln.plans import derived as D
from labelkiln.session import cut_lineage, fresh_dir
from labelkiln.sources.tasks import TASKS, TaskSpec


def clean(c: Column) -> Column:
    """Tabs and line breaks become spaces (they would split a TSV row)."""
    return F.regexp_replace(c, "[\\t\\r\\n]", " ")


def pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = D.table(spark, sf_dir, "conversations")
    u = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("text_a"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_b"))
    part = F.when(hash52("split:", F.col("conv_id"), ":", F.col("turn")) % 10 < 8, "train").otherwise("dev")
    return u.join(a, ["conv_id", "turn"]).select(
        "conv_id", "turn", (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("pair_id"),
        F.col("text_a"), F.col("text_b"), part.alias("part"))


def doc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.comments(spark, sf_dir)
    return c.withColumn("part", F.when(F.col("split") == "train", "train").otherwise("dev"))


_ROWS: dict[tuple[str, str, str], DataFrame] = {}


def _kept(spark: SparkSession, sf_dir: str, make) -> DataFrame:
    """``make(spark, sf_dir)`` (``doc_rows`` or ``pair_rows``), joined and written once per
    session: all tasks and both of their files are cut from that table."""
    key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
    if key not in _ROWS:
        _ROWS[key] = cut_lineage(make(spark, sf_dir), make.__name__)
    return _ROWS[key]


def write_ordered_text(df: DataFrame, key: str, line: Column, path: str, header: str | None = None) -> None:
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("_k"), line.alias("_line"))
    if header is not None:
        rows = rows.unionByName(spark.createDataFrame([(-1, header)], "_k bigint, _line string"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    (rows.repartitionByRange(n, "_k").sortWithinPartitions("_k").select("_line")
     .write.mode("errorifexists").text(path))


def _tsv(*cols) -> Column:
    return F.concat_ws("\t", *[c if isinstance(c, Column) else F.lit(c) for c in cols])


def _pick(labels, idx: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), idx.cast("int"))


# Header lines of the task files.
HEADERS = {
    "mrpc": "Quality\t#1 ID\t#2 ID\t#1 String\t#2 String",
    "mnli": "index\tpromptID\tpairID\tgenre\tsentence1_binary_parse\tsentence2_binary_parse\t"
            "sentence1_parse\tsentence2_parse\tsentence1\tsentence2\tlabel1\tgold_label",
    "sts-b": "index\tgenre\tfilename\tyear\told_index\tsource1\tsource2\tsentence1\tsentence2\tscore",
    "qqp": "id\tqid1\tqid2\tquestion1\tquestion2\tis_duplicate",
    "qnli": "index\tquestion\tsentence\tlabel",
    "rte": "index\tsentence1\tsentence2\tlabel",
    "wnli": "index\tsentence1\tsentence2\tlabel",
    "sst-2": "sentence\tlabel",
}


def task_lines(spark: SparkSession, sf_dir: str, task: str) -> tuple[DataFrame, str, Column, str | None]:
    """(rows with a ``part`` column, key column, line expression, header)."""
    spec = TASKS[task]
    if task in ("cola", "sst-2"):
        d = _kept(spark, sf_dir, doc_rows)
        text = clean(F.col("comment_text"))
        if task == "cola":
            return d, "doc_id", _tsv("src", F.col("toxic").cast("string"), "", text), None
        return d, "doc_id", _tsv(text, F.col("toxic").cast("string")), HEADERS["sst-2"]
    p = _kept(spark, sf_dir, pair_rows)
    a, b = clean(F.col("text_a")), clean(F.col("text_b"))
    pid, cid, turn = (F.col(c).cast("string") for c in ("pair_id", "conv_id", "turn"))
    k2, k3 = F.col("conv_id") % 2, F.col("conv_id") % 3
    if task == "mrpc":
        return p, "pair_id", _tsv(k2.cast("string"), cid, turn, a, b), HEADERS["mrpc"]
    if task in ("mnli", "mnli-mm"):
        lab = _pick(spec.labels, k3)
        return p, "pair_id", _tsv(pid, cid, turn, "conv", "", "", "", "", a, b, lab, lab), HEADERS["mnli"]
    if task == "sts-b":
        score = (F.col("turn") % 6).cast("double").cast("string")
        return p, "pair_id", _tsv(pid, "conv", "f", "2020", pid, "s1", "s2", a, b, score), HEADERS["sts-b"]
    if task == "qqp":
        full = _tsv(pid, cid, turn, a, b, k2.cast("string"))
        short = _tsv(pid, cid, turn, a)
        return p, "pair_id", F.when(F.col("conv_id") % 7 == 0, short).otherwise(full), HEADERS["qqp"]
    if task == "qnli":
        lab = F.when(F.col("conv_id") % 17 == 0, F.lit("not_sure")).otherwise(_pick(spec.labels, k2))
        return p, "pair_id", _tsv(pid, a, b, lab), HEADERS["qnli"]
    if task == "rte":
        return p, "pair_id", _tsv(pid, a, b, _pick(spec.labels, k2)), HEADERS["rte"]
    if task == "wnli":
        return p, "pair_id", _tsv(pid, a, b, k2.cast("string")), HEADERS["wnli"]
    if task == "boolq":
        rec = F.to_json(F.struct(F.col("pair_id").alias("idx"), F.col("text_a").alias("question"),
                                 F.col("text_b").alias("passage"), (k2 == 1).alias("label")))
        return p, "pair_id", rec, None
    raise KeyError(task)


def abuse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _kept(spark, sf_dir, doc_rows)
    text = (F.when(F.col("doc_id") % 11 == 0, F.lit("")).when(F.col("doc_id") % 13 == 0, F.lit("NA"))
            .otherwise(F.col("comment_text")))
    return d.select("part", "doc_id", F.col("doc_id").cast("string").alias("id"), text.alias("comment_text"),
                    "threat", "insult", "toxic", "IsAbuse")


def write_task(spark: SparkSession, sf_dir: str, spec: TaskSpec, out_dir: str) -> str:
    """Write the train and dev files of one task under ``out_dir``."""
    files = {"train": spec.train_file, "dev": spec.dev_file}
    if spec.fmt == "csv":
        rows = abuse_rows(spark, sf_dir)
        n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
        for part, fname in files.items():
            (rows.filter(F.col("part") == part).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
             .drop("part", "doc_id").write.option("header", True).option("quote", '"').option("escape", '"')
             .option("quoteAll", True).csv(f"{out_dir}/{fname}"))
        return out_dir
    rows, key, line, header = task_lines(spark, sf_dir, spec.name)
    for part, fname in files.items():
        write_ordered_text(rows.filter(F.col("part") == part), key, line, f"{out_dir}/{fname}", header)
    return out_dir


_WRITTEN: dict[tuple[str, str, str], str] = {}


def write_task_dir(spark: SparkSession, sf_dir: str, task: str) -> str:
    """The task folder for ``sf_dir``, written once per session (a fresh
    folder under the checkpoint root; files are never rewritten in place)."""
    key = (spark.sparkContext.applicationId, sf_dir, task)
    if key not in _WRITTEN:
        _WRITTEN[key] = write_task(spark, sf_dir, TASKS[task], fresh_dir(spark, f"task-{task}"))
    return _WRITTEN[key]


def write_named_records(spark: SparkSession, sf_dir: str, task: str) -> str:
    """Named records ``idx, <text fields>, label`` as Parquet: integer class
    labels, or the score for the regression task."""
    spec = TASKS[task]
    out = fresh_dir(spark, f"records-{task}") + "/records"
    if task in ("cola", "sst-2", "abuse"):
        d = doc_rows(spark, sf_dir)
        df = d.select(F.col("doc_id").alias("idx"), F.col("comment_text").alias(spec.record_fields[0]),
                      F.col("toxic").cast("bigint").alias("label"))
    else:
        p = pair_rows(spark, sf_dir)
        k = len(spec.labels) if spec.labels else 0
        label = (F.col("turn") % 6).cast("double") if k == 0 else (F.col("conv_id") % k).cast("bigint")
        a, b = F.col("text_a"), F.col("text_b")
        if task == "boolq":  # byte-string texts, as tensor records carry them
            a, b = F.encode(a, "UTF-8"), F.encode(b, "UTF-8")
        df = p.select(F.col("pair_id").alias("idx"), a.alias(spec.record_fields[0]),
                      b.alias(spec.record_fields[1]), label.alias("label"))
    df.write.parquet(out)
    return out


def write_comment_splits(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """clean_{train,val,test}.csv: comment_text and the four labels per split."""
    root = fresh_dir(spark, "comments")
    c = D.comments(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    paths = {}
    for split in ("train", "val", "test"):
        path = f"{root}/clean_{split}.csv"
        (c.filter(F.col("split") == split).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
         .select("comment_text", *D.LABEL_NAMES).write.option("header", True).option("quote", '"')
         .option("escape", '"').option("quoteAll", True).csv(path))
        paths[split] = path
    return paths

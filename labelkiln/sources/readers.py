"""Task file readers -> examples ``(set_type, row_idx, guid, text_a, text_b, label)``.

* TSV: read as text and split on tabs with no quoting (a quote is literal;
  the CSV reader would let quotes swallow tabs and pad short rows with nulls).
* JSONL: read as text (to keep the line number), parsed with ``from_json``.
* CSV: RFC-4180 quoting; quoted fields may hold newlines, and files are split all the same (``split_csv``).
* Named records: any columnar source with ``idx``, text fields and ``label``.

``row_idx`` is the physical line number (``with_file_row_index``), computed at
the scan before any filter. A path may be one file or a folder of part files
(read in path order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from labelkiln.operators.ordering import with_file_row_index
from labelkiln.sources.split_csv import read_split_csv
from labelkiln.sources.tasks import LAST, TaskSpec

EXAMPLE_COLS = ["set_type", "row_idx", "guid", "text_a", "text_b", "label"]

# The strings a pandas CSV read turns into missing values
# (its default NA list); rows whose text is one of them are dropped.
PANDAS_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``row_idx, value`` for every physical line, in file order."""
    return with_file_row_index(spark.read.text(path))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``row_idx, cols array<string>``; the -1 limit keeps trailing empty fields."""
    return read_lines(spark, path).select("row_idx", F.split(F.col("value"), "\t", -1).alias("cols"))


def _cell(idx) -> Column:
    """Column ``idx`` of the row (0-based; LAST = the last one); null when short."""
    cols = F.col("cols")
    if idx is None:
        return F.lit(None).cast("string")
    if idx == LAST:
        return F.element_at(cols, -1)
    return F.get(cols, int(idx))


def _examples(df: DataFrame, set_type: str, guid_tail: Column, a: Column, b: Column, label: Column) -> DataFrame:
    return df.select(F.lit(set_type).alias("set_type"), "row_idx",
                     F.concat(F.lit(set_type + "-"), guid_tail.cast("string")).alias("guid"),
                     a.alias("text_a"), b.cast("string").alias("text_b"), label.cast("string").alias("label"))


def needed_columns(spec: TaskSpec) -> int:
    """How many columns a row must have for its task."""
    places = [spec.text_a, spec.text_b, spec.label, spec.guid_col if spec.guid_from == "col" else None]
    return max((p + 1 for p in places if isinstance(p, int) and p != LAST), default=1)


def is_short(spec: TaskSpec) -> Column:
    return F.size("cols") < needed_columns(spec)


def tsv_examples(rows: DataFrame, spec: TaskSpec, set_type: str, on_short: str = "fail") -> DataFrame:
    """Rows with fewer columns than ``min_cols`` are skipped where the task says
    so; any other short row fails the job (``on_short='fail'``) or is left out
    (``'quarantine'``: see ``tsv_quarantine``)."""
    df = rows.filter(F.col("row_idx") >= spec.skip_rows)
    if spec.min_cols:
        df = df.filter(F.size("cols") >= spec.min_cols)
    if on_short == "quarantine":
        df = df.filter(~is_short(spec))
    elif on_short == "fail":
        told = F.concat(F.lit(f"{spec.name}: short row "), F.col("row_idx").cast("string"))
        df = df.withColumn("cols", F.when(is_short(spec), F.raise_error(told).cast("array<string>")).otherwise(F.col("cols")))
    else:
        raise ValueError(on_short)
    tail = F.col("row_idx") if spec.guid_from == "row" else _cell(spec.guid_col)
    return _examples(df, set_type, tail, _cell(spec.text_a), _cell(spec.text_b), _cell(spec.label))


def tsv_quarantine(rows: DataFrame, spec: TaskSpec) -> DataFrame:
    """``row_idx, n_cols`` of the short rows that ``on_short='quarantine'`` leaves out."""
    df = rows.filter(F.col("row_idx") >= spec.skip_rows)
    if spec.min_cols:
        df = df.filter(F.size("cols") >= spec.min_cols)
    return df.filter(is_short(spec)).select("row_idx", F.size("cols").alias("n_cols"))


BOOLQ_SCHEMA = T.StructType([T.StructField("idx", T.LongType()), T.StructField("question", T.StringType()),
                             T.StructField("passage", T.StringType()), T.StructField("label", T.BooleanType())])


BROKEN = "_broken"


def parsed_json(lines: DataFrame, spec: TaskSpec, schema: T.StructType) -> DataFrame:
    """``row_idx, value, j, bad``: the parsed lines; ``bad`` if a line is no JSON
    object of the schema or lacks a field of the task."""
    wide = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    read = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    needed = [f for f in (spec.guid_col, spec.text_a, spec.text_b, spec.label) if f is not None]
    bad = F.col("j").isNull() | F.col(f"j.{BROKEN}").isNotNull()
    for f in needed:
        bad |= F.col(f"j.{f}").isNull()
    return (lines.filter(F.col("row_idx") >= spec.skip_rows).withColumn("j", read).withColumn("bad", bad))


def jsonl_examples(lines: DataFrame, spec: TaskSpec, set_type: str, schema: T.StructType = BOOLQ_SCHEMA,
                   on_broken: str = "fail") -> DataFrame:
    """One JSON object per line. ``skip_rows`` applies to lines even though
    JSONL has no header (the first record is dropped by default). A broken line or
    a missing field fails the job (``on_broken='fail'``) or is left out
    (``'quarantine'``: see ``jsonl_quarantine``)."""
    df = parsed_json(lines, spec, schema)
    if on_broken == "quarantine":
        df = df.filter(~F.col("bad"))
    elif on_broken == "fail":
        told = F.concat(F.lit(f"{spec.name}: broken line "), F.col("row_idx").cast("string"))
        df = df.withColumn("j", F.when(F.col("bad"), F.raise_error(told).cast(df.schema["j"].dataType)).otherwise(F.col("j")))
    else:
        raise ValueError(on_broken)
    lab = F.col(f"j.{spec.label}")
    label = F.when(lab, F.lit("True")).when(~lab, F.lit("False")) if isinstance(
        schema[spec.label].dataType, T.BooleanType) else lab.cast("string")
    b = F.col(f"j.{spec.text_b}") if spec.text_b else F.lit(None)
    return _examples(df, set_type, F.col(f"j.{spec.guid_col}"), F.col(f"j.{spec.text_a}"), b, label)


def jsonl_quarantine(lines: DataFrame, spec: TaskSpec, schema: T.StructType = BOOLQ_SCHEMA) -> DataFrame:
    """``row_idx, value`` of the lines that ``on_broken='quarantine'`` leaves out."""
    return parsed_json(lines, spec, schema).filter("bad").select("row_idx", "value")


ABUSE_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("comment_text", T.StringType()),
                             T.StructField("threat", T.IntegerType()), T.StructField("insult", T.IntegerType()),
                             T.StructField("toxic", T.IntegerType()), T.StructField("IsAbuse", T.IntegerType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             multi_line: bool = True) -> DataFrame:
    """RFC-4180 CSV (doubled quotes inside quoted fields) with ``row_idx``, the record's
    position in file order. With a header, columns are taken by name in any order and a
    missing one is an error; without one, by position. Quoted fields may hold newlines
    and files are split all the same (``split_csv``); for files known to have none,
    ``multi_line=False`` uses Spark's own reader. An empty field is null."""
    reader = (spark.read.option("header", header).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"').option("mode", "FAILFAST"))
    names = schema.fieldNames()
    if header:
        # the header line alone: every column as a string, in the file's order
        names = reader.option("inferSchema", False).csv(path).columns
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)}")
    if multi_line:
        return read_split_csv(spark, path, schema, names, header)
    types = {f.name: f.dataType for f in schema.fields}
    in_file = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    rows = with_file_row_index(reader.schema(in_file).option("enforceSchema", False).csv(path))
    empty_is_null = [F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                     for f in schema.fields]
    return rows.select(*empty_is_null, "row_idx")


def is_missing_text(c: Column) -> Column:
    return c.isNull() | c.isin(list(PANDAS_NA))


def csv_examples(spark: SparkSession, path: str, spec: TaskSpec, set_type: str,
                 schema: T.StructType = ABUSE_SCHEMA, multi_line: bool = True) -> DataFrame:
    """Row position counts every data row, also the ones then dropped for a
    missing text (index first, filter second)."""
    rows = read_csv(spark, path, schema, multi_line=multi_line).select("row_idx", spec.text_a, spec.label)
    kept = rows.filter(~is_missing_text(F.col(spec.text_a)))
    return _examples(kept, set_type, F.col("row_idx"), F.col(spec.text_a), F.lit(None), F.col(spec.label))


def read_task(spark: SparkSession, spec: TaskSpec, data_dir: str, split: str = "train",
              multi_line: bool = True) -> DataFrame:
    """Examples of one split ("train" or "dev") of a task folder. ``multi_line=False`` is
    for CSV files known to hold no newline inside quotes."""
    fname = spec.train_file if split == "train" else spec.dev_file
    set_type = "train" if split == "train" else spec.dev_set
    path = f"{data_dir.rstrip('/')}/{fname}"
    if spec.reader is not None:  # a registered task's own reader
        return spec.reader(spark, path, set_type).select(*EXAMPLE_COLS)
    if spec.fmt == "tsv":
        return tsv_examples(read_tsv(spark, path), spec, set_type)
    if spec.fmt == "jsonl":
        return jsonl_examples(read_lines(spark, path), spec, set_type)
    if spec.fmt == "csv":
        return csv_examples(spark, path, spec, set_type, multi_line=multi_line)
    raise ValueError(f"unknown format {spec.fmt}")


def read_task_all(spark: SparkSession, spec: TaskSpec, data_dir: str) -> DataFrame:
    return read_task(spark, spec, data_dir, "train").unionByName(read_task(spark, spec, data_dir, "dev"))


def named_record_examples(records: DataFrame, spec: TaskSpec, set_type: str = "train",
                          label_list_map: bool = True) -> DataFrame:
    """Named records ``idx, <text fields>, label`` -> examples: guid is the
    record's idx, texts are UTF-8 strings (binary columns are decoded), the
    label becomes its string; with ``label_list_map`` an integer label of a
    classification task is replaced by that entry of the label list."""
    def text(name):
        c = F.col(name)
        return F.decode(c, "UTF-8") if dict(records.dtypes)[name] == "binary" else c.cast("string")
    a = text(spec.record_fields[0])
    b = text(spec.record_fields[1]) if len(spec.record_fields) > 1 else F.lit(None).cast("string")
    label = F.col("label").cast("string")
    if label_list_map and spec.labels and len(spec.labels) > 1:
        label = F.get(F.array(*[F.lit(x) for x in spec.labels]), F.col("label").cast("int"))
    return records.select(F.lit(set_type).alias("set_type"), F.col("idx").cast("bigint").alias("row_idx"),
                          F.col("idx").cast("string").alias("guid"), a.alias("text_a"), b.alias("text_b"),
                          label.alias("label"))


COMMENT_SCHEMA = T.StructType([T.StructField("comment_text", T.StringType()),
                               T.StructField("threat", T.IntegerType()), T.StructField("insult", T.IntegerType()),
                               T.StructField("toxic", T.IntegerType()), T.StructField("IsAbuse", T.IntegerType())])


def read_comment_splits(spark: SparkSession, paths: dict[str, str], schema: T.StructType = COMMENT_SCHEMA,
                        multi_line: bool = True) -> DataFrame:
    """One CSV per split -> one table with a ``split`` column and the row
    position inside its file."""
    out = None
    for split, path in paths.items():
        df = read_csv(spark, path, schema, multi_line=multi_line).withColumn("split", F.lit(split))
        df = df.select(*schema.fieldNames(), "row_idx", "split")
        out = df if out is None else out.unionByName(df)
    return out

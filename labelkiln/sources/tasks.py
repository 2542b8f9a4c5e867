"""Task registry: how each task's files map onto the example schema.

An example is ``(set_type, row_idx, guid, text_a, text_b, label)`` with every
value a string (text_b may be null). A task is data, not code: a new task is a
new ``TaskSpec`` passed to ``register_task``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

CLASSIFICATION = "classification"
REGRESSION = "regression"
LAST = -1  # "last column of the row"


@dataclass(frozen=True)
class TaskSpec:
    name: str
    fmt: str                          # "tsv" | "jsonl" | "csv"
    train_file: str
    dev_file: str
    dev_set: str                      # set name used in dev guids
    skip_rows: int                    # physical lines dropped at the top
    guid_from: str                    # "row" (line number) | "col" (a column) | "field" (JSON/CSV field)
    guid_col: int | str | None
    text_a: int | str
    text_b: int | str | None
    label: int | str
    labels: tuple[str, ...] | None    # label list; position = label id
    mode: str = CLASSIFICATION
    min_cols: int | None = None       # rows with fewer columns are skipped
    record_fields: tuple[str, ...] = field(default=())  # text fields of named records
    reader: object = None             # optional (spark, path, set_type) -> examples DataFrame

    @property
    def num_labels(self) -> int:
        return 1 if self.mode == REGRESSION else len(self.labels or ())


# File names, set names, header rows, column positions, label
# lists and output modes of each task.
_SPECS = [
    TaskSpec("mrpc", "tsv", "train.tsv", "dev.tsv", "dev", 1, "row", None, 3, 4, 0, ("0", "1"),
             record_fields=("sentence1", "sentence2")),
    TaskSpec("mnli", "tsv", "train.tsv", "dev_matched.tsv", "dev_matched", 1, "col", 0, 8, 9, LAST,
             ("contradiction", "entailment", "neutral"), record_fields=("premise", "hypothesis")),
    TaskSpec("mnli-mm", "tsv", "train.tsv", "dev_mismatched.tsv", "dev_matched", 1, "col", 0, 8, 9, LAST,
             ("contradiction", "entailment", "neutral"), record_fields=("premise", "hypothesis")),
    TaskSpec("cola", "tsv", "train.tsv", "dev.tsv", "dev", 0, "row", None, 3, None, 1, ("0", "1"),
             record_fields=("sentence",)),
    TaskSpec("sst-2", "tsv", "train.tsv", "dev.tsv", "dev", 1, "row", None, 0, None, 1, ("0", "1"),
             record_fields=("sentence",)),
    TaskSpec("sts-b", "tsv", "train.tsv", "dev.tsv", "dev", 1, "col", 0, 7, 8, LAST, None, REGRESSION,
             record_fields=("sentence1", "sentence2")),
    TaskSpec("qqp", "tsv", "train.tsv", "dev.tsv", "dev", 1, "col", 0, 3, 4, 5, ("0", "1"), min_cols=6,
             record_fields=("question1", "question2")),
    TaskSpec("qnli", "tsv", "train.tsv", "dev.tsv", "dev_matched", 1, "col", 0, 1, 2, LAST,
             ("entailment", "not_entailment"), record_fields=("question", "sentence")),
    TaskSpec("rte", "tsv", "train.tsv", "dev.tsv", "dev", 1, "col", 0, 1, 2, LAST,
             ("entailment", "not_entailment"), record_fields=("sentence1", "sentence2")),
    TaskSpec("wnli", "tsv", "train.tsv", "dev.tsv", "dev", 1, "col", 0, 1, 2, LAST, ("0", "1"),
             record_fields=("sentence1", "sentence2")),
    TaskSpec("boolq", "jsonl", "train.jsonl", "val.jsonl", "dev", 1, "field", "idx", "question", "passage",
             "label", ("False", "True"), record_fields=("question", "passage")),
    TaskSpec("abuse", "csv", "cleaned_train.csv", "cleaned_val.csv", "dev", 0, "row", None, "comment_text", None,
             "IsAbuse", ("0", "1"), record_fields=("comment_text",)),
]

TASKS: dict[str, TaskSpec] = {s.name: s for s in _SPECS}


def register_task(spec: TaskSpec) -> None:
    TASKS[spec.name] = spec


def get_task(name: str) -> TaskSpec:
    """Unknown task names raise KeyError, as a lookup in the registry does."""
    if name not in TASKS:
        raise KeyError(name)
    return TASKS[name]


def output_mode(name: str) -> str:
    return get_task(name).mode


def num_labels(name: str) -> int:
    return get_task(name).num_labels

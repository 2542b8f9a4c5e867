"""The best model per key, published by a manifest.

A model is written aside, in a folder of its own, and becomes the current one by one
appended manifest row that names it. A crash between the two leaves the old model in
place, and a reader sees either the old row or the new one. A model is published only
if its metric is strictly better than the current one's; the first one always is.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "encoder string, label_name string, metric double, epoch int, path string, version long"


class ModelStore:
    """Weights per (encoder, label) under ``root`` (a folder that all executors see)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> DataFrame:
        """All rows ever published; none before the first."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def current(self) -> DataFrame:
        """The current row of each key."""
        last = F.max_by(F.struct("metric", "epoch", "path", "version"), "version").alias("m")
        return self.manifest().groupBy("encoder", "label_name").agg(last).select("encoder", "label_name", "m.*")

    def write_aside(self, weights: np.ndarray) -> str:
        """Weights as a table of their own; not yet visible to readers."""
        path = f"{self.root}/models/{uuid.uuid4().hex}"
        rows = [(int(i), float(v)) for i, v in enumerate(weights)]
        self.spark.createDataFrame(rows, "position int, weight double").coalesce(1).write.parquet(path)
        return path

    def publish(self, models: Mapping[tuple[str, str], tuple[float, int, np.ndarray]]) -> int:
        """``{(encoder, label): (metric, epoch, weights)}``: writes those that are strictly
        better than the current ones and names them in one appended manifest file; the
        number published. A NaN metric is never better."""
        now = {(r["encoder"], r["label_name"]): r for r in self.current().collect()}  # one row per key
        rows = []
        for key, (metric, epoch, weights) in models.items():
            old = now.get(key)
            if old is None and metric == metric or old is not None and metric > old["metric"]:
                rows.append((*key, float(metric), int(epoch), self.write_aside(weights), (old["version"] if old else 0) + 1))
        if rows:
            self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return len(rows)

    def load(self, encoder: str, label_name: str) -> np.ndarray:
        """Weights of the current model; KeyError without one."""
        row = self.current().filter((F.col("encoder") == encoder) & (F.col("label_name") == label_name)).first()
        if row is None:
            raise KeyError((encoder, label_name))
        got = self.spark.read.parquet(row["path"]).toArrow()
        out = np.zeros(got.num_rows)
        out[got.column("position").to_numpy()] = got.column("weight").to_numpy()
        return out

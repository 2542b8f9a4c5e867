"""The stateless scoring operators on a streaming source.

The dense head and the inclusive threshold are row-local projections, so the
same expressions run unchanged under Structured Streaming: a file source of
embedding rows in, scored rows out, exactly-once through the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelkiln.operators import metrics as M
from labelkiln.operators import models as MO


def score(df: DataFrame, vec_col: str = "embedding", threshold: float = 0.48) -> DataFrame:
    """Adds ``p`` (dense head probability) and ``pred`` (p >= threshold);
    works on batch and streaming DataFrames alike."""
    return df.withColumn("p", MO.dense_head_udf()(F.col(vec_col))).withColumn("pred", M.predict("p", threshold))


def stream_scores(spark: SparkSession, source_dir: str, sink: str, checkpoint: str, schema=None,
                  vec_col: str = "embedding", threshold: float = 0.48, files_per_trigger: int = 1,
                  glob: str | None = None):
    """Score every file that lands in ``source_dir`` (optionally only names
    matching ``glob``) into a Parquet ``sink``. Returns the running query
    (``availableNow``: it stops when the backlog is done, so a batch job and a
    continuous deployment share one code path)."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    schema = schema or reader.parquet(source_dir).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        stream = stream.option("pathGlobFilter", glob)
    stream = stream.parquet(source_dir)
    out = score(stream, vec_col, threshold)
    return (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())

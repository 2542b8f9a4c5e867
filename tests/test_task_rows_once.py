"""The rows behind the task files are joined once for all tasks."""

from pyspark.sql import functions as F

from labelkiln.sources import fixtures as FX
from labelkiln.sources.tasks import TASKS


def test_document_tasks_share_one_table(spark, tmp_path):
    ids = spark.range(60).withColumnRenamed("id", "doc_id")
    ids.withColumn("text", F.concat(F.lit("text "), F.col("doc_id").cast("string"))).write.parquet(f"{tmp_path}/documents.parquet")
    ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit(1).alias("quality")).write.parquet(
        f"{tmp_path}/labels.parquet")
    FX._ROWS.clear()
    for task in ("cola", "sst-2", "abuse"):
        FX.write_task(spark, str(tmp_path), TASKS[task], f"{tmp_path}/{task}")
    assert [k[2] for k in FX._ROWS] == ["doc_rows"]
    assert sum(spark.read.text(f"{tmp_path}/cola/{f}").count() for f in (TASKS["cola"].train_file, TASKS["cola"].dev_file)) == 60

"""The streaming query over a table that is one file, and one that is a folder of parts."""

from pyspark.sql import functions as F

from labelkiln.plans import catalog
from labelkiln.plans import text_queries  # noqa: F401  (registers the query)


def test_one_file_and_part_files_give_the_same_rows(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("label"), F.transform(
        F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(F.col("id") + i).cast("float")).alias("embedding"))
    run = catalog.QUERIES["stream_dense_head_scores"]
    rows.repartition(4).write.parquet(f"{tmp_path}/parts/embeddings.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/aside")
    (tmp_path / "one").mkdir()
    part = next((tmp_path / "aside").glob("part-*.parquet"))
    (tmp_path / "one" / "embeddings.parquet").write_bytes(part.read_bytes())
    got = [sorted(map(tuple, run(spark, f"{tmp_path}/{d}").collect())) for d in ("parts", "one")]
    assert len(got[0]) == 40 and got[0] == got[1]

"""Class weights are broadcast, whatever the planner thinks of their size."""

from labelkiln.operators import sampling as SA


def test_row_weights_do_not_shuffle_the_rows(spark):
    rows = spark.range(100).selectExpr("id AS doc_id", "'a' AS label_name", "cast(id % 2 AS int) AS y")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = SA.row_weights(rows, SA.class_weights(SA.class_counts(rows)))
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert out.filter("weight = 1.0 / 50").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

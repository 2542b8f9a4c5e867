"""Registered queries give identical rows at 1, 4 and 13 shuffle partitions
(bucket counts follow the partition count) and with small file splits."""

import pytest

import __spark_entry__ as E
from oracle_harness import spark_rows

SF = "/root/testdata/sf0.01"
NAMES = ["shuffle_limit", "weighted_resample", "roc_auc_by_label", "pearson_spearman", "bce_loss_by_batch",
         "threshold_sweep_f1", "read_qqp", "encode_pair"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_at_any_partitioning(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    results = []
    try:
        for n, split in ((1, "128MB"), (4, "16KB"), (13, "4KB")):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            results.append(spark_rows(E.queries()[name](spark, SF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old_split)
    assert results[0] == results[1] == results[2]

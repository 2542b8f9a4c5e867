"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "labelkiln",
                  shuffle_partitions: int | None = None, driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """A session tuned for these jobs. On a cluster pass ``master=None`` and let
    spark-submit decide; shuffle partitions should then be sized to the data."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": driver_memory,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Uses the cluster's ``spark.checkpoint.dir`` (or the directory already set on
    the context). Only a local-mode session without one gets a fresh temporary
    folder; a cluster session without one is an error, because a machine-local
    folder is not visible to other executors."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            d = tempfile.mkdtemp(prefix="labelkiln-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, unique folder under the scratch root (never reused, never cleared)."""
    root = scratch_root(spark)
    path = f"{root}/{tag}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        # only a single-JVM session may use the driver's own file system
        local = path[len("file:"):] if path.startswith("file:") else path
        if "://" not in local:
            os.makedirs(local, exist_ok=True)
    return path


def cut_lineage(df, tag: str = "table"):
    """Materialise ``df`` as a Parquet table in a fresh folder under the shared
    checkpoint root and continue from that table: one job (an eager RDD
    checkpoint computes its input twice), a columnar result that later reads
    can prune, and nothing kept on executors, so losing one costs nothing."""
    path = fresh_dir(df.sparkSession, f"cut-{tag}") + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(scan, target: int | None = None):
    """Round-robin a *scan* over the cluster when it yields fewer partitions
    than there are cores (e.g. one large row group), so CPU-heavy row-local
    work (regex splits, tokenizing) does not run on one core. On large inputs
    the scan already has enough splits and this is a no-op. Only for plans
    without a shuffle: asking a shuffled plan for its partition count would
    run its upstream stages."""
    sc = scan.sparkSession.sparkContext
    want = target or sc.defaultParallelism
    if scan.rdd.getNumPartitions() < want:
        return scan.repartition(want)
    return scan


def rebalance(df, target: int | None = None):
    """Spread rows evenly over ``target`` (default: all cores) partitions before
    a Python step; AQE would otherwise merge small shuffle outputs into a few
    partitions and leave the UDF on a few cores."""
    return df.repartition(target or df.sparkSession.sparkContext.defaultParallelism)

"""Session helpers: configuration and reliable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tile joins feed aggregates on other keys, so splitting a hot tile is worth one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Kernels cost far more than their rows weigh: partitions are coalesced to the number of cores, not to a megabyte.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
}


def build_session(master: str, name: str = "strollgraph", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a new folder only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(folder)


_STAGES: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the reliable checkpoint folder and read it back.

    Lineage ends there, later reads prune columns, and its real size is known to the planner.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stage-{uuid.uuid4().hex}"
    _STAGES.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage tables written so far; call it when no result that reads them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    count = 0
    while _STAGES:
        path = jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        count += path.getFileSystem(conf).delete(path, True)
    return count

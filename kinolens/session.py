"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_conf(shuffle_bytes: int) -> dict:
    """Shuffle partitions for the largest exchange that is expected.

    Adaptive execution merges small partitions but never splits below the
    number it starts with, so the start must fit the data: 10 TB of exchanged
    rows need about 80,000 partitions of 128 MB.
    """
    n = max(1, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n), "spark.sql.shuffle.partitions": str(n)}


def build_session(
    app: str = "kinolens", master: str | None = None, conf: dict | None = None, shuffle_bytes: int | None = None
) -> SparkSession:
    """Session with the engine's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = shuffle_conf(shuffle_bytes) if shuffle_bytes else {}
    for key, value in {**CLUSTER_CONF, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required, because a machine-local folder is
    not visible to the other executors. A local master may go without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    base = tempfile.mkdtemp(prefix=f"run-kinolens-{os.getpid()}-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never used path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a parquet table in the shared folder."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store its scheme names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

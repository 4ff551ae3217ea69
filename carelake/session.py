"""Session settings the engine is tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes and splits hot shuffle partitions;
# dynamic overwrite replaces only the partitions a job actually touches.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Stream state outside the heap, written as changes.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # HotSpot leaves methods above 8000 bytes of bytecode uncompiled; wide cleaning
    # projections run several times faster split up than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Bring a session built elsewhere in line where it still has the default."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == "65535":
        spark.conf.set(limit, SETTINGS[limit])
    state = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBacked" in spark.conf.get(state):
        spark.conf.set(state, SETTINGS[state])
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local path would be invisible to the other executors.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="carelake-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared root and read back: what follows neither
    recomputes it nor depends on the executors that did."""
    path = shared_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)

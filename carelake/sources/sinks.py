"""Partitioned tables, idempotent loads, the ledger and keyed stores."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.windows import top_per_key


def observed(seen: Observation) -> dict:
    """Metrics of a finished write. A plan that the optimizer finds empty never runs its
    metrics and has none to give: that is an empty dict, once the write has succeeded."""
    try:
        return seen.get
    except Py4JJavaError as none:
        if "AssertionError" not in str(none.java_exception):
            raise
        return {}


def write_partitioned(df: DataFrame, path: str, keys: list[str], rebalance: bool = True) -> int:
    """Replace the partitions present in `df` and return the rows written.

    By default rows are rebalanced on the partition keys first: each partition gets
    few, well-sized files, and a partition with a large share of the rows is split
    over several tasks. That is a shuffle of everything written, so a narrow job
    whose input is already laid out by the same keys passes rebalance=False. The
    count is observed during the write; nothing is read back.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    placed = counted.hint("rebalance", *[F.col(k) for k in keys]) if rebalance else counted
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*keys)
        .parquet(path)
    )
    return observed(seen).get("rows", 0)


def replace_partition(
    df: DataFrame, root: str, source: str, uf: str, year: int, month: int
) -> tuple[str, int]:
    """Load one raw partition; a second load of the same period replaces the first.

    The partition's own folder is overwritten whole, so a load without rows empties it.
    """
    path = f"{root}/{source}/uf={uf}/ano={year:04d}/mes={month:02d}"
    seen = Observation()
    counted = df.drop("uf", "ano", "mes").observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        counted.hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "zstd")
        .parquet(path)
    )
    return path, observed(seen).get("rows", 0)


def write_catalog_snapshot(entries: DataFrame, path: str) -> int:
    """One audit partition per day and state: a rerun replaces it, other days stay."""
    return write_partitioned(entries, path, ["dt", "uf"])


LEDGER = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("source", "uf", "competencia")]
)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def mark_completed(spark: SparkSession, path: str, done: DataFrame) -> int:
    """Add newly finished (source, uf, competencia) rows to the ledger."""
    keys = [f.name for f in LEDGER]
    fresh = done.select(*keys).distinct().join(
        read_or_empty(spark, path, LEDGER), keys, "left_anti"
    )
    seen = Observation()
    fresh.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return observed(seen).get("rows", 0)


BUCKETS = 64
BUCKET = "balde"


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """Hash bucket of a key: a row's place in a keyed store."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def keyed_schema(schema: T.StructType) -> T.StructType:
    """Columns of a keyed store: its rows and the bucket it is partitioned by."""
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def insert_or_ignore(
    batch: DataFrame, path: str, schema: T.StructType, key: str, order: list, buckets: int = BUCKETS
) -> None:
    """Append the rows whose key is not stored yet; the first of a batch's rows wins.

    The store is partitioned by a hash bucket of the key. A batch reads the key column of
    its own buckets only, as a partition filter, so its cost follows the batch and not the
    store; each bucket gets one file. Rows without a key are left out. Running a batch
    twice adds nothing the second time.
    """
    spark, c = batch.sparkSession, F.col
    wanted = batch.where(c(key).isNotNull()).select(*schema.fieldNames())
    first = top_per_key(wanted, [key], order, 1).withColumn(BUCKET, bucket_of(key, buckets)).persist()
    try:
        touched = [r[0] for r in first.select(BUCKET).distinct().collect()]  # at most `buckets`
        if not touched:
            return
        known = stored_keys(spark, path, schema, key, touched)
        fresh = first.join(known, [BUCKET, key], "left_anti")
        fresh.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
    finally:
        first.unpersist()


def stored_keys(spark: SparkSession, path: str, schema: T.StructType, key: str, touched: list[int]) -> DataFrame:
    """Bucket and key of the stored rows in the given buckets."""
    rows = read_or_empty(spark, path, keyed_schema(schema))
    return rows.where(F.col(BUCKET).isin(touched)).select(BUCKET, key)


def kafka_sink(alerts: DataFrame, servers: str, topic: str) -> None:
    """Publish rows as flat JSON, keyed by event."""
    (
        alerts.select(
            F.col("id_evento").alias("key"), F.to_json(F.struct("*")).alias("value")
        )
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


# Layer -> the database schema it is loaded into.
LAYERS = ("raw", "trusted", "refined")


def write_layer(df: DataFrame, url: str, layer: str, table: str, properties: dict) -> None:
    """Load a table into one of the layered database schemas over JDBC."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    df.write.mode("append").jdbc(url, f"{layer}.{table}", properties=properties)

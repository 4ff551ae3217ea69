"""Expressions and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from carelake.session import shared_path

BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers batches of BATCH_BYTES, where the session still has Spark's 64 MB:
    a batch is held several times, in the executor's Arrow buffers and in its worker."""
    if spark.conf.get(BATCH_LIMIT) == "67108864b":
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_blanks(text: Column) -> Column:
    """The text without every blank of the six, null as empty."""
    empty = F.lit("")
    return reduce(
        lambda done, blank: F.replace(done, F.lit(blank), empty), BLANK_CHARACTERS, F.coalesce(text, empty)
    )


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def learning_fold(doc_id: Column) -> Column:
    """True for the rows a model may learn from: crc32 of the id as text, mod 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back: later uses neither
    recompute it nor depend on an executor that computed it."""
    path = shared_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def keyed(docs: DataFrame, fields: str) -> StructType:
    """Schema of doc_id, with the type it has, and further fields that may be null."""
    return StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *StructType.fromDDL(fields)])

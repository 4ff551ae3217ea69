"""Distinct counts for any period from theta sketches stored per month.

One pass per month writes, for each column, a sketch of its values; a period is the union
of its months' sketches, so nothing is counted twice and no raw row is read again. A month
delivered anew replaces its own sketches. A sketch keeps up to 2^LOG_ENTRIES hashes: below
that the count is exact, above it the error is bounded (RELATIVE_ERROR, at three standard
deviations).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.sources.sinks import write_partitioned

LOG_ENTRIES = 12
EXACT = 1 << LOG_ENTRIES
RELATIVE_ERROR = 3 / EXACT**0.5

PERIOD = ["ano", "mes"]


def _value(df: DataFrame, name: str) -> Column:
    """NULL and '' are no value."""
    text = F.col(name).cast("string")
    return F.when(text != "", text)


def month_sketches(df: DataFrame, columns: list[str], groups: list[str] | None = None) -> DataFrame:
    """(ano, mes, [groups], coluna, linhas, nulos, esboco): one row per month and column.

    `df` carries ano and mes and whatever `groups` names, for instance a facility. Each task
    adds its rows to one sketch per month and column; sketches are merged in the shuffle.
    """
    keys = [*PERIOD, *(groups or [])]
    n = F.count(F.lit(1))
    wide = df.groupBy(*keys).agg(
        n.alias("linhas"),
        *[(n - F.count(_value(df, x))).alias(f"n_{x}") for x in columns],
        *[F.theta_sketch_agg(_value(df, x), F.lit(LOG_ENTRIES)).alias(f"s_{x}") for x in columns],
    )
    pairs = [
        F.struct(F.lit(x).alias("coluna"), F.col(f"n_{x}").alias("nulos"), F.col(f"s_{x}").alias("esboco"))
        for x in columns
    ]
    return wide.select(*keys, "linhas", F.explode(F.array(*pairs)).alias("_p")).select(
        *keys, "_p.coluna", "linhas", "_p.nulos", "_p.esboco"
    )


def write_sketches(df: DataFrame, columns: list[str], path: str, groups: list[str] | None = None) -> int:
    """Sketches of the months in `df`, each replacing what the month had before."""
    return write_partitioned(month_sketches(df, columns, groups), path, PERIOD)


def read_sketches(spark: SparkSession, path: str, groups: str = "") -> DataFrame:
    """The stored sketches; `groups` is the DDL of further grouping columns."""
    known = "coluna string, linhas bigint, nulos bigint, esboco binary, ano int, mes int"
    return spark.read.schema(f"{groups}, {known}" if groups else known).parquet(path)


def distinct_in_period(
    sketches: DataFrame, first: tuple[int, int], last: tuple[int, int], groups: list[str] | None = None
) -> DataFrame:
    """(coluna, linhas, nulos, distintos, exato, menor, maior) from the first month to the
    last, both included. Below EXACT values the count is exact; otherwise the true one lies
    between menor and maior."""
    c = F.col
    month = c("ano") * 12 + c("mes")
    inside = (
        # The years alone prune partitions before the months are looked at.
        c("ano").between(first[0], last[0])
        & month.between(first[0] * 12 + first[1], last[0] * 12 + last[1])
    )
    merged = (
        sketches.where(inside)
        .groupBy(*(groups or []), "coluna")
        .agg(
            F.sum("linhas").alias("linhas"),
            F.sum("nulos").alias("nulos"),
            F.theta_sketch_estimate(F.theta_union_agg("esboco", F.lit(LOG_ENTRIES))).alias("distintos"),
        )
    )
    exact = c("distintos") < EXACT
    room = F.when(exact, 0).otherwise(F.ceil(c("distintos") * RELATIVE_ERROR))
    return merged.select(
        *(groups or []),
        "coluna",
        "linhas",
        "nulos",
        "distintos",
        exact.alias("exato"),
        (c("distintos") - room).alias("menor"),
        (c("distintos") + room).alias("maior"),
    )

"""Ranked selections. A filtered row_number gets a per-partition group limit
ahead of its shuffle, so a hot key ships at most n rows per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank_name: str | None = None
) -> DataFrame:
    rank = rank_name or "_rank"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(rank) <= n)
    return kept if rank_name else kept.drop(rank)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """ORDER BY .. LIMIT n; callers end `order` with a unique key."""
    return df.orderBy(*order).limit(n)

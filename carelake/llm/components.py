"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node and component (the smallest node that is reachable) for edges (left, right).

    Each round a node is taken into the first of itself and its neighbours, and edges
    within a node go (in the first round repeated ones too), so that later rounds read few. First is the smallest
    in every other round, which takes a star whose centre is smallest at once, and by a hash
    in the others, which halve long chains. Rounds are written tables: no lineage
    grows, nothing is gathered, and a hot node is one row per task in the grouped minima.
    """
    rest = stored(spark, edges.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct(), "edges")
    labels, turn = None, 0
    while labels is None or not rest.isEmpty():
        rank = (lambda node: F.xxhash64(F.lit(turn), node)) if turn % 2 else F.col  # noqa: B023
        first = F.least(*[F.struct(rank(node).alias("rank"), F.col(node).alias("next")) for node in ("left", "right")])
        met = rest.select(F.explode(F.array("left", "right")).alias("node"), first.alias("first"))
        step = stored(spark, met.groupBy("node").agg(F.min("first").alias("first")).select("node", "first.next"), "steps")
        def moved(frame: DataFrame, column: str) -> DataFrame:
            """The column's nodes replaced by what takes them in, after the first round twice."""
            for _ in range(min(turn, 1) + 1):  # noqa: B023
                frame = frame.join(step.withColumnRenamed("node", column), column, "left")  # noqa: B023
                frame = frame.withColumn(column, F.coalesce("next", column)).drop("next")
            return frame

        if labels is None:
            labels = step.withColumnRenamed("next", "component")
        else:
            labels = stored(spark, moved(labels, "component"), "labels")
        rest = moved(moved(rest, "left"), "right").where("left <> right")
        rest = rest.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"))
        rest = stored(spark, rest if turn else rest.distinct(), "edges")
        turn += 1
    smallest = labels.groupBy("component").agg(F.min("node").alias("least"))
    return stored(spark, labels.join(smallest, "component").select("node", F.col("least").alias("component")), "labels")

"""Exact interpolated percentiles without gathering a group in one task.

Values are folded to (keys, value, count), written once, and the rows at the wanted ranks
are found by narrowing the bits of the values (`selection`): a band with many values in
it, however small or narrow, is refined until what is left can be sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.selection import BOUND, double_ordinal, rows_at_ranks
from carelake.session import stored


def with_quantiles(
    basic: DataFrame,
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
) -> DataFrame:
    """`basic` (one row per key) with the percentiles of `value` in `df`; a NULL key
    is a group like any other, so the keys are matched null-safe."""
    c = F.col
    on = [c(f"b.{k}").eqNullSafe(c(f"q.{k}")) for k in keys]
    found = exact_quantiles(df, keys, value, probs, weight)
    return basic.alias("b").join(found.alias("q"), on, "left").select(
        "b.*", *[c(f"q.{name}") for name in probs]
    )


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
    bound: int = BOUND,
) -> DataFrame:
    """One row per key with a double column per entry of `probs`.

    NULL keys form a group of their own, as in GROUP BY; NULL values do not count, NaN is
    above every number. `weight` names a column that says how often a row counts. Runs a
    few jobs when called.
    """
    c = F.col
    folded = (
        df.where(c(value).isNotNull())
        .select(*keys, c(value).cast("double").alias("_v"), (c(weight) if weight else F.lit(1)).alias("_w"))
        .groupBy(*keys, "_v")
        .agg(F.sum("_w").alias("_n"))
    )
    counts = stored(df.sparkSession, folded.withColumn("_o", double_ordinal(c("_v"))), "values")

    # Each percentile needs the values at two neighbouring ranks.
    last = c("_total") - 1
    place = {name: last * F.lit(float(p)) for name, p in probs.items()}
    want = F.array(
        *[
            F.struct(
                F.lit(name).alias("p"),
                F.lit(part).alias("part"),
                F.least(F.floor(at) + part, last).alias("rank"),
                (at - F.floor(at)).alias("frac"),
            )
            for name, at in place.items()
            for part in (0, 1)
        ]
    )
    points = rows_at_ranks(counts, keys, lambda ranged: ranged.withColumn("_want", want), bound=bound)

    def at(name, part):
        return F.max(F.when((c("_t.p") == name) & (c("_t.part") == part), c("_v")))

    def interpolated(name):
        frac = F.max(F.when(c("_t.p") == name, c("_t.frac")))
        step = F.when((frac > 0) & (at(name, 1) != at(name, 0)), (at(name, 1) - at(name, 0)) * frac)
        return (at(name, 0) + F.coalesce(step, F.lit(0.0))).alias(name)

    return points.groupBy(*keys).agg(*[interpolated(name) for name in probs])

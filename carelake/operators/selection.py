"""Exact rows at given ranks, found by narrowing 64-bit ordinals, 16 bits at a time.

A table of (keys, ordinal, count) is summed by the first 16 bits of the ordinal; running
sums say which prefix holds each wanted rank, and only rows with such a prefix go on to
the next 16 bits. It ends as soon as every open prefix has at most `bound` rows left,
which alone are sorted. No step holds more than 65,536 sums or `bound` rows of a key in one
place, however the values are distributed, and each step reads the rows once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import stored

SHIFTS = (48, 32, 16, 0)
BOUND = 10_000  # rows of one key that are sorted at the end

_ONE = 1 << 52  # mantissa steps of a double


def double_ordinal(value: Column) -> Column:
    """A bigint in the order of the doubles: infinities at the ends, NaN above all, the
    zeros equal. Neighbouring doubles have neighbouring ordinals."""
    size = F.abs(value)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    # A logarithm next to a power of two may round to the wrong side of it.
    exponent = (
        F.when(size >= F.pow(F.lit(2.0), guess) * 2, guess + 1)
        .when((size < F.pow(F.lit(2.0), guess)) & (guess > -1022), guess - 1)
        .otherwise(guess)
    )
    mantissa = (size / F.pow(F.lit(2.0), exponent) * _ONE).cast("bigint")
    bits = (
        F.when(F.isnan(value), F.lit(2048 * _ONE - 1))
        .when(size == 0, F.lit(0))
        .when(size == float("inf"), F.lit(2047 * _ONE))
        .otherwise((exponent + 1022) * _ONE + mantissa)
    )
    return F.when(value < 0, -bits).otherwise(bits).cast("bigint")


def matching(left: str, right: str, names: dict[str, str]) -> Column:
    """Null-safe equality of the named columns: a NULL key is a group like any other."""
    terms = [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}")) for a, b in names.items()]
    return reduce(lambda x, y: x & y, terms)


def _inside(rows: DataFrame, targets: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """The rows whose prefix holds a wanted rank, with that prefix and its ranks."""
    left = rows.withColumn("_at", F.shiftright("_o", shift)).alias("v")
    on = matching("v", "t", {**{k: k for k in keys}, "_at": "_prefix"})
    return left.join(targets.alias("t"), on).select("v.*", F.col("t._want"))


def rows_at_ranks(
    rows: DataFrame,
    keys: list[str],
    wanted: Callable[[DataFrame], DataFrame],
    order: list[str] | None = None,
    bound: int = BOUND,
) -> DataFrame:
    """The rows at the wanted ranks of each key: their columns and `_t`, what was wanted.

    `rows` has the keys, `_o` (the ordinal) and `_n` (how often the row counts), and is
    read once per step. `wanted` adds `_want`, an array of structs with a 0-based `rank`
    and any further fields, to a frame with the keys and `_total`, the count of the key.
    `order` breaks ties between equal ordinals. Runs a job per step when called.
    """
    c, spark = F.col, rows.sparkSession
    targets, shift = None, SHIFTS[0]
    for step in SHIFTS:
        inner = rows if targets is None else _inside(rows, targets, keys, shift)
        within = [] if targets is None else ["_at"]
        sums = inner.groupBy(*keys, *within, F.shiftright("_o", step).alias("_prefix")).agg(
            F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_rows")
        )
        group = Window.partitionBy(*keys, *within)
        ranged = sums.select(
            "*",
            F.sum("_size").over(group.orderBy("_prefix")).alias("_hi"),
            F.sum("_size").over(group).alias("_total"),
        )
        if targets is None:
            ranged = wanted(ranged)
        else:
            on = matching("r", "t", {**{k: k for k in keys}, "_at": "_prefix"})
            ranged = ranged.alias("r").join(targets.alias("t"), on).select("r.*", "t._want")
        low = c("_hi") - c("_size")
        here = F.filter("_want", lambda t: (t["rank"] >= low) & (t["rank"] < c("_hi")))
        found = ranged.select(
            *keys, "_prefix", "_rows", F.transform(here, lambda t: t.withField("rank", t["rank"] - low)).alias("_want")
        )
        targets, shift = stored(spark, found.where(F.size("_want") > 0), "ranks"), step
        if (targets.agg(F.max("_rows")).first()[0] or 0) <= bound:
            break
    running = Window.partitionBy(*keys, "_at").orderBy("_o", *(order or []))
    placed = _inside(rows, targets, keys, shift).withColumn("_hi", F.sum("_n").over(
        running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ))
    here = F.filter("_want", lambda t: (t["rank"] >= c("_hi") - c("_n")) & (t["rank"] < c("_hi")))
    return placed.select(*rows.columns, F.explode(here).alias("_t"))

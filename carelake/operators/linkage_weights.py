"""Linkage weights estimated from the tables instead of assumed.

The Fellegi-Sunter model sees a candidate pair only through its agreement pattern: which
of the comparators agree. Expectation maximisation over the pattern counts gives, for each
comparator, the chance that a true pair agrees (m) and that any other pair does (u).

Pairs are never formed. For every set of comparators, the pairs that agree on at least
these are a join of counts by key, one after another; inclusion and exclusion turn these sums into
the counts of exact patterns: eight numbers for three comparators, whatever the tables' size.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.session import shared_path, stored

BLOCK = ["cnes", "_ano"]
#: Comparator -> tolerance: 0 for equality, n for n days or years either side.
COMPARATORS = {"sexo": 0, "idade": 1, "data": 1}
ROUNDS = 200
START_M, START_U, START_SHARE = 0.9, 0.1, 0.001


def _subsets(names: list[str]) -> list[tuple[str, ...]]:
    return list(chain.from_iterable(combinations(names, k) for k in range(len(names) + 1)))


def _folded(records: DataFrame, names: list[str], count: str) -> DataFrame:
    """Records per block and combination of comparator values."""
    blocked = records.where(F.col("cnes").isNotNull() & F.col("data").isNotNull())
    return blocked.withColumn("_ano", F.year("data")).groupBy(*BLOCK, *names).agg(F.count(F.lit(1)).alias(count))


def _shifted(frame: DataFrame, name: str, tolerance: int) -> DataFrame:
    """Every row once for each value within the tolerance of its own."""
    steps = F.explode(F.array(*[F.lit(i) for i in range(-tolerance, tolerance + 1)]))
    moved = frame.withColumn("_step", steps)
    value = F.date_add(F.col(name), F.col("_step")) if name == "data" else F.col(name) + F.col("_step")
    return moved.withColumn(name, value).drop("_step")


def agreement_patterns(
    adm: DataFrame, deaths: DataFrame, comparators: dict[str, int] | None = None
) -> DataFrame:
    """(comparators..., pares): candidate pairs of one facility and year by which of the
    comparators agree (1 or 0; a NULL never agrees). Both sides have cnes, data and the
    comparators; `data` is the date that gives the year."""
    comparators = comparators or COMPARATORS
    names = list(comparators)
    spark, c = adm.sparkSession, F.col
    left = stored(spark, _folded(adm, names, "_a"), "link-left")
    right = stored(spark, _folded(deaths, names, "_b"), "link-right")

    def agreeing(subset: tuple[str, ...]) -> DataFrame:
        a = left.groupBy(*BLOCK, *subset).agg(F.sum("_a").alias("_a"))
        b = right.groupBy(*BLOCK, *subset).agg(F.sum("_b").alias("_b"))
        for name in subset:
            if comparators[name]:
                b = _shifted(b, name, comparators[name])
        # A day over the turn of the year keeps the block of its own year: no admission has it.
        # Merged by the hint: the planner takes a side for as small as it was before its shifted rows.
        pairs = a.join(b.hint("merge"), [*BLOCK, *subset]).agg(F.coalesce(F.sum(c("_a") * c("_b")), F.lit(0)).alias("_at_least"))
        return pairs.select(*[F.lit(int(x in subset)).alias(x) for x in names], "_at_least")

    # One job and one row for each set: the plan of all would hold every join twice.
    path = shared_path(spark, "link-at-least")
    for subset in _subsets(names):
        (row := agreeing(subset)).write.mode("append").parquet(path)
    counted = spark.read.schema(row.schema).parquet(path)
    # Exactly these = at least these, less those of every larger set, by alternating signs.
    wider = counted.select(*[c(x).alias(f"w_{x}") for x in names], c("_at_least").alias("_w"))
    contains = reduce(lambda x, y: x & y, [c(f"w_{x}") >= c(x) for x in names])
    extra = sum((c(f"w_{x}") - c(x) for x in names), F.lit(0))
    exact = F.sum(F.when(extra % 2 == 0, c("_w")).otherwise(-c("_w")))
    return counted.join(F.broadcast(wider), contains).groupBy(*names).agg(exact.alias("pares"))  # 8 rows a side


def estimate_probabilities(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """{"share": ..., comparator: (m, u)} by expectation maximisation over the patterns.

    The driver holds one number per pattern. Probabilities stay inside (0, 1), so that
    every weight is finite."""
    names = [x for x in patterns.columns if x != "pares"]
    rows = [([r[x] for x in names], r["pares"]) for r in patterns.orderBy(*names).collect()]
    share, m, u = START_SHARE, [START_M] * len(names), [START_U] * len(names)
    total = sum(n for _, n in rows)
    if not total:
        return {"share": 0.0, **{x: (START_M, START_U) for x in names}}
    bounded = lambda p: min(max(p, 1e-9), 1 - 1e-9)
    for _ in range(rounds):
        belief = []
        for agrees, _n in rows:
            true, other = share, 1 - share
            for k, hit in enumerate(agrees):
                true *= m[k] if hit else 1 - m[k]
                other *= u[k] if hit else 1 - u[k]
            belief.append(true / (true + other))
        matched = sum(b * n for b, (_, n) in zip(belief, rows))
        share = bounded(matched / total)
        for k in range(len(names)):
            hits = sum(b * n for b, (agrees, n) in zip(belief, rows) if agrees[k])
            others = sum((1 - b) * n for b, (agrees, n) in zip(belief, rows) if agrees[k])
            m[k] = bounded(hits / matched) if matched else m[k]
            u[k] = bounded(others / (total - matched)) if matched < total else u[k]
    return {"share": share, **{x: (m[k], u[k]) for k, x in enumerate(names)}}


def estimated_weights(adm: DataFrame, deaths: DataFrame, comparators: dict[str, int] | None = None) -> dict[str, tuple[float, float]]:
    """(m, u) per comparator, in the form that link_scored takes."""
    found = estimate_probabilities(agreement_patterns(adm, deaths, comparators))
    return {name: pair for name, pair in found.items() if name != "share"}

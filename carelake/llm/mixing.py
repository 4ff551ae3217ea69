"""Mixing sources to target weights by iterative proportional fitting.

Token totals per (source, language, topic) cell are raked until each marginal has its
target share. A cell's factor is raked over observed tokens; documents are then kept with
a probability proportional to their cell's factor, calibrated so that the expected tokens
meet the budget, never above one.

The cells are the combinations of the classes the targets name, with one pooled class
per dimension for all other values, so their number is bounded by the targets and not by
the corpus: only these sums reach the driver. They are summed map-side, so a source with
a third of all rows is one row per task. Documents are drawn by a hash of their id: the
same ids are kept on a retried task, at any partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import stored, table
from carelake.llm.token_rollup import words

#: Topic by the first pattern a text matches, else "prose".
TOPICS = {
    "legal": r"(?i)licen[sc]ed under|rights reserved|copyright|warranty",
    "contact": r"@[\w-]+\.\w|\+?\d[\d -]{8,}\d",
    "web": r"https?://|www\.",
}
OTHER = "(other)"
#: Target token shares. Values not named are pooled and keep the share they have.
TARGETS = {
    "source": {f"src{i}": 1.0 for i in range(20)},
    "lang": {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2},
    "topic": {"prose": 0.8, "legal": 0.05, "contact": 0.1, "web": 0.05},
}
BUDGET = 0.6  # expected share of the tokens that stays
ROUNDS, TOLERANCE = 200, 1e-9
SEED = 7


def topic(text: Column) -> Column:
    found = None
    for name, pattern in TOPICS.items():
        hit = text.rlike(pattern)
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return found.otherwise("prose")


def pooled(value: Column, named: Mapping[str, float]) -> Column:
    return F.when(value.isin(*named), value).otherwise(OTHER)


def rake(observed: np.ndarray, targets: list[np.ndarray], rounds=ROUNDS, tolerance=TOLERANCE) -> np.ndarray:
    """Observed cells scaled until every marginal has its target (sums equal to the total).

    Cells without tokens stay empty. Targets that no scaling of the filled cells can meet
    leave the closest state of the last round.
    """
    cells = observed.astype(float)
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(targets):
            others = tuple(a for a in range(cells.ndim) if a != axis)
            now = cells.sum(axis=others)
            factor = np.divide(target, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, float(np.abs(factor - 1).max(initial=0, where=(now > 0) & (target > 0))))
            cells *= factor.reshape([-1 if a == axis else 1 for a in range(cells.ndim)])
        if worst < tolerance:
            break
    return cells


def marginals(observed: np.ndarray, classes: list[list[str]], targets: list[Mapping[str, float]]) -> list[np.ndarray]:
    """Target tokens per class: pooled classes keep theirs, the named share the rest by
    their weights; a named class without tokens gives its share to the others."""
    out = []
    for axis, (names, weights) in enumerate(zip(classes, targets)):
        now = observed.sum(axis=tuple(a for a in range(observed.ndim) if a != axis))
        wanted = np.array([0.0 if n == OTHER else float(weights[n]) for n in names]) * (now > 0)
        rest = sum(t for n, t in zip(names, now) if n == OTHER)
        share = wanted / wanted.sum() if wanted.sum() > 0 else wanted
        out.append(np.array([t if n == OTHER else (now.sum() - rest) * s for n, t, s in zip(names, now, share)]))
    return out


def calibrate(observed: np.ndarray, raked: np.ndarray, targets: list[np.ndarray], budget: float) -> np.ndarray:
    """Probability per cell. Expected tokens are raked to the budget's share of each target
    with no cell above what it has; if marginals then stay short of the budget, the cells
    with room make up for it in proportion (or give all they hold)."""
    filled = raked > 0
    goal = min(budget * observed.sum(), observed[filled].sum())
    cells = np.minimum(raked * budget, observed)
    for _ in range(ROUNDS):
        before = cells
        for axis, target in enumerate(targets):
            others = tuple(a for a in range(cells.ndim) if a != axis)
            now = cells.sum(axis=others)
            factor = np.divide(target * budget, now, out=np.ones_like(now), where=now > 0)
            cells = np.minimum(cells * factor.reshape([-1 if a == axis else 1 for a in range(cells.ndim)]), observed)
        if np.abs(cells - before).max(initial=0) <= TOLERANCE * max(1.0, goal):
            break
    for _ in range(observed.size + 1):
        free = filled & (cells < observed)
        missing = goal - cells.sum()
        if abs(missing) <= 1e-12 * max(1.0, goal) or not cells[free].sum() > 0:
            break
        cells = np.where(free, np.minimum(cells * (1 + missing / cells[free].sum()), observed), cells)
    return np.divide(cells, observed, out=np.zeros_like(cells), where=observed > 0)


class Mix:
    """docs: doc_id, text, source, lang (other columns pass through untouched).

    Null or unlisted sources and languages belong to the pooled class. Null and empty
    texts have no tokens and the topic prose; they are drawn like their cell. Repeated rows
    share their id's draw, and rows without id share one. An empty table gives an empty
    result.
    """

    def __init__(self, targets=None, budget: float = BUDGET, seed: int = SEED):
        self.targets, self.budget, self.seed = targets or TARGETS, budget, seed

    def cells(self, docs: DataFrame, *keep: str) -> DataFrame:
        """The kept columns, the class of each dimension (mix_<dimension>) and n_tokens."""
        values = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.coalesce("text", F.lit("")))}
        classes = [pooled(values[d], named).alias(f"mix_{d}") for d, named in self.targets.items()]
        return docs.select(*keep, *classes, words(F.col("text")).alias("n_tokens"))

    def _observed(self, cells: DataFrame) -> tuple[np.ndarray, list[list[str]], np.ndarray]:
        """Tokens and documents per cell, and the classes along each axis."""
        keys = [f"mix_{d}" for d in self.targets]
        sums = cells.groupBy(*keys).agg(F.sum("n_tokens").alias("n"))
        classes = [[*named, OTHER] for named in self.targets.values()]
        observed = np.zeros([len(c) for c in classes])
        empty = np.zeros(observed.shape, bool)
        for *key, n in sums.collect():  # at most the product of the target lists
            at = tuple(c.index(k) for c, k in zip(classes, key))
            observed[at], empty[at] = n, n == 0
        return observed, classes, empty

    def plan(self, cells: DataFrame) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[np.ndarray]]:
        """Probability and tokens per cell, the classes along each axis and their targets."""
        observed, classes, empty = self._observed(cells)
        targets = marginals(observed, classes, list(self.targets.values()))
        chance = calibrate(observed, rake(observed, targets), targets, self.budget)
        # A cell of documents without any token has nothing to rake: it is kept whole.
        return np.where(empty, 1.0, chance), observed, classes, targets

    def shares(self, docs: DataFrame) -> list[tuple[str, str, float, float]]:
        """(dimension, class, share asked for, expected share) of the tokens drawn."""
        chance, observed, classes, targets = self.plan(self.cells(docs))
        drawn, out = chance * observed, []
        for axis, (name, names, target) in enumerate(zip(self.targets, classes, targets)):
            now = drawn.sum(axis=tuple(a for a in range(drawn.ndim) if a != axis))
            for c, t, n in zip(names, target, now):
                out.append((name, c, t / max(target.sum(), 1e-300), n / max(drawn.sum(), 1e-300)))
        return out

    def draw(self, cells: DataFrame) -> DataFrame:
        """A frame of `cells` (with doc_id among the kept columns) with probability and kept;
        columns of these names are replaced. The probabilities are a literal array: rows
        meet them without a join."""
        chance, _, classes, _ = self.plan(cells)
        place = F.lit(0)
        for name, names in zip(self.targets, classes):
            known = F.array(*[F.lit(x) for x in names])
            place = place * len(names) + F.array_position(known, F.col(f"mix_{name}")).cast("int") - 1
        chances = F.array(*[F.lit(x) for x in chance.ravel().tolist()])
        point = F.pmod(F.xxhash64(F.lit(self.seed), "doc_id"), F.lit(1 << 53)) / F.lit(float(1 << 53))
        placed = cells.withColumn("probability", F.get(chances, place))
        return placed.withColumn("kept", point < F.col("probability"))

    def sample(self, docs: DataFrame) -> DataFrame:
        """The documents kept, with their own columns."""
        narrow = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "text", "source", "lang")
        return self.draw(self.cells(narrow, "row", "doc_id")).where("kept").select("row.*")


def op2_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its cell, tokens, probability and whether it is in the sample.
    The patterns meet each text once; what follows reads a narrow table."""
    mix = Mix()
    cells = mix.cells(table(spark, sf_dir, "documents"), "doc_id", "source", "lang")
    return mix.draw(stored(spark, cells, "cells")).select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), "n_tokens", "probability", "kept"
    )

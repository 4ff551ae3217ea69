"""Periodic runs of words: stretches that repeat with a smallest period, and their collapse.

Method, for each text (descending-LCP Kruskal):

1. A run of period q whose length is e times q or more starts at two places, s and s + q,
   whose suffixes share at least (e - 1) q words. So only texts in which a short word
   sequence occurs twice can hold a run; hashes find these texts, never missing one.
2. In such a text words become numbers (exactly, by a dictionary), suffixes are ordered by
   prefix doubling, and the lengths that neighbours share (LCP) are counted.
3. Neighbouring suffixes are united by decreasing LCP with union-find. Each class keeps its
   positions in order, the smaller set moves into the larger. Two positions that become
   adjacent share exactly the LCP of the union; if their distance is within that LCP, they
   are a seed: the stretch from the first to the end of what is shared has their distance
   as period. A third position between them would give a smaller period, so every seed has
   its smallest one, and the leftmost seed of each run gives the whole run.

One text is one task's work; memory follows the longest text, not the table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import WORD, keyed, table
from carelake.llm.wordhash import WordHasher, canonical, mixed, pieces

MIN_LENGTH, MIN_EXPONENT = 6, 4
RUN = "struct<start: long, length: long, period: long>"


def least_shared(min_length: int, min_exponent: int) -> int:
    """Words that the two first places of any run share at least."""
    return min(max((min_exponent - 1) * q, min_length - q) for q in range(1, max(2, min_length)))


def with_repeats(hasher: WordHasher, texts: list[bytes], size: int) -> set[int]:
    """Numbers of the texts in which some sequence of so many words may occur twice."""
    found = set()
    for first, last in pieces(texts):
        words, counts = hasher.words(texts[first:last])
        grams = hasher.runs(words, size)
        doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)[: len(grams)]
        inside = np.arange(len(grams)) + size <= np.cumsum(counts)[doc.astype(np.int64)]
        doc = doc[inside]
        keys = grams[inside] ^ mixed(doc, 1)
        order = np.argsort(keys)
        twice = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
        found.update((first + np.unique(doc[order[twice]]).astype(np.int64)).tolist())
    return found


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Start places of the suffixes in lexicographic order, by prefix doubling."""
    n, step, rank = len(ids), 1, ids.astype(np.int64)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - step)] = rank[step:] + 1
        keys = rank * (n + 1) + ahead
        order = np.argsort(keys, kind="stable")
        steps = np.concatenate([[0], np.cumsum(keys[order[1:]] != keys[order[:-1]])])
        rank[order] = steps
        if steps[-1] == n - 1 or step >= n:
            return order
        step *= 2


def shared_lengths(ids: list[int], order: list[int]) -> np.ndarray:
    """Words shared by each suffix and the one before it in order (the first: 0)."""
    n, shared, out = len(ids), 0, np.zeros(len(ids), np.int64)
    place = [0] * n
    for k, start in enumerate(order):
        place[start] = k
    for start in range(n):
        k = place[start]
        if not k:
            shared = 0
            continue
        other = order[k - 1]
        most = n - max(start, other)
        while shared < most and ids[start + shared] == ids[other + shared]:
            shared += 1
        out[k] = shared
        shared = max(0, shared - 1)
    return out


def find_runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word list, by start, then period."""
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    n, least = len(ids), least_shared(min_length, min_exponent)
    if n < least + 1:
        return []
    order = suffix_order(np.array(ids)).tolist()
    shared = shared_lengths(ids, order)
    picked = np.flatnonzero(shared >= least)
    picked = picked[np.argsort(-shared[picked], kind="stable")].tolist()

    parent: dict[int, int] = {}
    positions: dict[int, list[int]] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    runs = set()
    for k in picked:
        common = int(shared[k])
        small, large = root(order[k - 1]), root(order[k])
        if len(positions.get(small, "1")) > len(positions.get(large, "1")):
            small, large = large, small
        fresh = positions.pop(small, None) or [small]
        held = positions.setdefault(large, [large])
        parent[small] = large
        for x in fresh:
            insort(held, x)
        for x in fresh:
            at = bisect_left(held, x)
            for i, j in zip(held[max(0, at - 1) : at + 1], held[max(1, at) : at + 2]):
                period = j - i
                if period * (min_exponent - 1) > common or period + common < min_length:
                    continue
                leftmost = i == 0 or ids[i - 1] != ids[j - 1]
                if leftmost and (j + common == n or ids[i + common] != ids[j + common]):
                    runs.add((i, period + common, period))
    return sorted(runs)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside every run's part after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    covered = np.cumsum(edge[:-1])
    return [words[i] for i in np.flatnonzero(covered == 0)]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of docs (doc_id, text; others are left out): doc_id, n_words,
    runs (array of start, length, period, by start, then period), strongest (the run with
    the greatest length / period; ties: smallest start, then period; null without a run)
    and collapsed, the text without the repeats, its words joined by one space.

    Words are runs of anything but the six blanks. A run has at least min_length words and
    min_exponent (2 or more) periods. A null or empty text has no words, no runs and an
    empty collapsed text. Ids are only carried: null or repeated ones change nothing."""
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run needs at least two periods and one word")
    least = least_shared(min_length, min_exponent)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = [canonical(t) for t in batch.column(1).to_pylist()]
            candidates = with_repeats(hasher, texts, least)
            found: list[list[tuple[int, int, int]]] = []
            for k, text in enumerate(texts):
                runs = []
                if k in candidates:
                    words = text.split()
                    if runs := find_runs(words, min_length, min_exponent):
                        texts[k] = b" ".join(collapse(words, runs))
                found.append(runs)
            best = [max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None for runs in found]
            counts = [len(t.split()) for t in batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array([[dict(zip(fields, r)) for r in runs] for runs in found], pa.list_(kind)),
                    pa.array([r and dict(zip(fields, r)) for r in best], kind),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )

    fields = ("start", "length", "period")
    kind = pa.struct([(f, pa.int64()) for f in fields])
    schema = keyed(docs, f"n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string")
    return docs.select("doc_id", "text").mapInArrow(search, schema)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, the text of one document in ten made periodic from some word on.

    With h the crc32 of the id's decimal form and g = h / 10: where h ends in 0, words from
    a = g % n on repeat the first p = 1 + (n - a) / (3 + g % 8) of them. A null id: no change."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    )
    cut = chosen.selectExpr("*", "size(words) as n", "h div 10 as g").selectExpr("*", "cast(g % n as int) as a")
    made = cut.selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) as int) as p")
    tail = "transform(sequence(0, n - a - 1), i -> words[a + i % p])"
    periodic = F.expr(f"array_join(concat(slice(words, 1, a), {tail}), ' ')")
    return made.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, with the planted ones, and what is left after collapsing."""
    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    return periodic_runs(planted(table(spark, sf_dir, "documents"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join(transform(runs, r -> {line}), '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

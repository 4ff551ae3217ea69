"""Pieces shared by the two text classifiers: bounded samples, hashed subwords, packed rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
REMEMBERED = 300_000  # words a worker keeps; the table is emptied beyond


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return LETTERS.findall((text or "").lower())


def bucket(piece: str, buckets: int) -> int:
    """The same on every machine and in every process."""
    return crc32(piece.encode("utf-8", "surrogatepass")) % buckets


def by_hash(frame: DataFrame, seed: int, most: int) -> DataFrame:
    """At most so many rows, the ones whose id hashes lowest: the same on every run.

    The planner keeps that many rows per task and one task merges them; most is a bound."""
    return frame.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most)


class Table(dict):
    """A bounded word table: a missing word is computed and kept."""

    def __init__(self, compute: Callable[[str], object]):
        super().__init__()
        self.compute = compute

    def __missing__(self, word: str):
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = self.compute(word)
        return value


def offsets(lengths) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments (starts has one entry more than there are segments)."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]

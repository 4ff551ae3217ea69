"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of all documents, labels unseen, is
the unlabelled set. With the class prior p, the risk on negatives is the risk of calling
the unlabelled negative less p times that of calling the positives negative. A flexible
model drives this difference below zero by memorising; the non-negative estimator then
steps back along it, which stops the memorising.

The model is linear over hashed subwords (a document's distinct words and their
beginnings, and which of them are frequent in it), trained in numpy in one task from a bounded sample. Only subwords whose
share among the positives differs clearly from their share in the unlabelled set have a
weight, and near copies are learnt from once: that keeps chance words of a long or often
copied document out of the scores, and the model is a few hundred weights at most. It is broadcast, and every whole text is scored where it was read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import keyed, learning_fold, table
from carelake.llm.linear import Table, bucket, by_hash, offsets, segment_sums, words_of
from carelake.llm.wordhash import mixed

BUCKETS = 1 << 32  # few subwords have a weight, so the space is wide: chance collisions are rare
FREQUENT, EVERY = BUCKETS, 200
BEGINNINGS = (4, 5, 6)
POSITIVES, UNLABELLED = 3000, 6000  # documents learnt from, at most
CLEAR = 5.0  # standard errors between a subword's shares in the two sets
MINIMA, ALIKE = 16, 10  # texts that share so many of these minimum hashes are taken as copies,
SHORT = 32  # if they have this many subwords
MOST_WEIGHTS = 20_000
STEPS, RATE, DECAY = 250, 0.1, 1e-5
PRIOR = 0.05  # where the labels give none
THRESHOLD = 0.7


def features(word: str) -> list[int]:
    parts = [f"={word}", *(word[:n] for n in BEGINNINGS if len(word) >= n)]
    return [bucket(p, BUCKETS) for p in parts]


def met_and_frequent(text: str | None, parts: Callable[[str], list[int]]) -> set[int]:
    """Buckets of the subwords that a document has, and once more (FREQUENT higher) those it
    has at least twice and on average once in EVERY words."""
    words, times = words_of(text), Counter()
    for word, n in Counter(words).items():
        for f in parts(word):
            times[f] += n
    return times.keys() | {f + FREQUENT for f, n in times.items() if n > 1 and n * EVERY >= len(words)}


def document_features(text: str | None) -> np.ndarray:
    return np.array(sorted(met_and_frequent(text, features)), dtype=np.uint64)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def one_of_each_family(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The rows without near copies of an earlier row: the words of a text that was copied
    would otherwise look as if many documents had chosen them. Rows of fewer than SHORT
    subwords stay: people write the same few words independently. At most POSITIVES or
    UNLABELLED rows come in."""
    signs = np.zeros((len(rows), MINIMA), np.uint64)
    for i, row in enumerate(rows):
        if len(row) >= SHORT:
            signs[i] = [mixed(row, seed).min() for seed in range(1, MINIMA + 1)]
    leaders, kept = np.zeros_like(signs), []
    for i, row in enumerate(rows):
        if len(row) < SHORT or ((leaders[: len(kept)] == signs[i]).sum(axis=1) < ALIKE).all():
            leaders[len(kept)] = signs[i]  # a short row leads nothing: its minima are 0
            kept.append(row)
    return kept


def clear_subwords(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Ascending ids of the subwords whose shares of documents differ clearly: by the root of
    the likelihood ratio statistic, which holds for rare subwords and few documents too."""
    ids, place = np.unique(np.concatenate([*positive, *unlabelled]), return_inverse=True)
    cut = sum(map(len, positive))
    k = np.bincount(place[:cut], minlength=len(ids)), np.bincount(place[cut:], minlength=len(ids))
    n = len(positive), len(unlabelled)
    share = (k[0] + k[1]) / (n[0] + n[1])
    ratio = np.zeros(len(ids))
    for with_it, docs in zip(k, n):
        for seen, expected in ((with_it, docs * share), (docs - with_it, docs * (1 - share))):
            ratio += 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))
    apart = np.sqrt(np.maximum(ratio, 0))
    best = np.argsort(-apart, kind="stable")[:MOST_WEIGHTS]
    return np.sort(ids[best[apart[best] >= CLEAR]])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(subwords, weights, bias): full-batch Adam on the non-negative risk."""
    bias = float(np.log(prior / (1 - prior)))
    given, everything = len(positive), len(unlabelled)
    positive, unlabelled = one_of_each_family(positive), one_of_each_family(unlabelled)
    if positive and unlabelled:  # the prior among texts that are counted once
        prior = min(max(prior * (len(positive) / given) / (len(unlabelled) / everything), 1e-3), 0.5)
        bias = float(np.log(prior / (1 - prior)))
    n_pos, n_all = len(positive), len(positive) + len(unlabelled)
    if not n_pos or n_all == n_pos:
        return np.zeros(0, np.uint64), np.zeros(0), bias
    used = clear_subwords(positive, unlabelled)
    rows = [np.searchsorted(used, r[np.isin(r, used)]) for r in (*positive, *unlabelled)]
    flat, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
    starts, owner = offsets(lengths), np.repeat(np.arange(n_all), lengths)
    w, first, second = np.zeros(len(used) + 1), 0.0, 0.0
    w[-1] = bias
    is_pos = np.arange(n_all) < n_pos
    for step in range(1, STEPS + 1):
        z = segment_sums(w[flat], starts) + w[-1]
        s = sigmoid(z)
        negative_risk = softplus(z[~is_pos]).mean() - prior * softplus(z[is_pos]).mean()
        on_pos = -prior * (1 - s[is_pos]) / n_pos  # slope of the positives' own risk
        off_pos, off_all = -prior * s[is_pos] / n_pos, s[~is_pos] / (n_all - n_pos)
        slope = np.empty(n_all)
        if negative_risk >= 0:
            slope[is_pos], slope[~is_pos] = on_pos + off_pos, off_all
        else:  # the estimate fell below what a risk can be: step back along it
            slope[is_pos], slope[~is_pos] = -off_pos, -off_all
        grad = np.bincount(flat, weights=slope[owner], minlength=len(w)).astype(float)
        grad[-1] = slope.sum()
        grad[:-1] += DECAY * w[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return used, w[:-1], float(w[-1])


class ToxicityModel:
    """fit learns from labels (doc_id, toxic) and documents (doc_id, text); score adds nothing
    but doc_id and score. Duplicated labels count once, toxic if any row says so; null
    labels and labels without a document are ignored. Without a positive document every
    score is the prior."""

    def __init__(self, subwords: np.ndarray, weights: np.ndarray, bias: float):
        self.weights = dict(zip(subwords.tolist(), weights.tolist()))
        self.bias = bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame) -> ToxicityModel:
        spark = docs.sparkSession
        own = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        own = own.where(learning_fold(F.col("doc_id")))
        prior = own.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
        prior = min(max(PRIOR if prior is None else prior, 1e-3), 0.5)
        ids = docs.select("doc_id").where(learning_fold(F.col("doc_id")))
        chosen = by_hash(own.where("toxic = 1").select("doc_id"), 1, POSITIVES).withColumn("positive", F.lit(True)).unionByName(
            by_hash(ids, 2, UNLABELLED).withColumn("positive", F.lit(False))
        )
        # At most POSITIVES + UNLABELLED ids: small enough for every task.
        texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("positive", "text")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                packed = [document_features(t.as_py()).tobytes() for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(packed, pa.binary())], ["positive", "features"])

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = sorted((p.as_py(), f.as_py()) for b in batches for p, f in zip(b.column(0), b.column(1)))
            unpack = [(p, np.frombuffer(f, np.uint64)) for p, f in rows]
            model = train([f for p, f in unpack if p], [f for p, f in unpack if not p], prior)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

        packed = texts.mapInArrow(pack, "positive boolean, features binary")
        learnt = packed.repartition(1).mapInArrow(learn, "model binary").first()
        if learnt is None:  # nothing to learn from
            return cls(*train([], [], prior))
        return cls(*pickle.loads(learnt[0]))

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and score of every whole text; null and empty texts have the bias alone."""
        shared = docs.sparkSession.sparkContext.broadcast((self.weights, self.bias))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, bias = shared.value
            worth = Table(lambda word: [f for f in features(word) if f in weights or f + FREQUENT in weights])
            for batch in batches:
                z = []
                for text in batch.column("text"):
                    met = met_and_frequent(text.as_py(), worth.__getitem__)
                    z.append(sum(weights.get(f, 0.0) for f in sorted(met)))
                scores = sigmoid(np.array(z, dtype=float) + bias)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

        narrow = docs.select("doc_id", "text")
        return narrow.mapInArrow(run, keyed(docs, "score double"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs; extra columns are ignored.

    Rows with a null doc_id are never learnt from and count as not held out."""
    scored = ToxicityModel.fit(docs, labels).score(docs)
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

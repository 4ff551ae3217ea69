"""Language identification: averaged hashed subword embeddings with a linear softmax.

A document is the mean of the embeddings of its words' subwords (the word and its
character n-grams, hashed); a linear layer and a softmax give the language. Embeddings and
layer are trained together by stochastic gradient descent in numpy, in one task, from a
bounded number of documents per language. A temperature fitted on documents held back from
that sample makes the score a probability; the same documents set the score below which a
prediction is rejected.

Mean and layer are linear, so after training each bucket has one vector of language
scores, and a word the mean of its buckets': a worker scores a text by adding up words.
The bucket table (a few MB) is broadcast; texts are scored where they were read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import keyed, learning_fold, table
from carelake.llm.linear import REMEMBERED, bucket, offsets, segment_sums, words_of

BUCKETS, WIDTH = 1 << 16, 12
GRAMS = (2, 3, 4)
PER_LANGUAGE = 400  # documents learnt from, at most, per language
EPOCHS, BATCH, RATE, SEED = 6, 16, 2.0, 11
HELD_BACK = 5  # every fifth sampled document calibrates
PRECISION = 0.99  # accepted predictions are right this often on the documents held back
UNKNOWN = "und"


def subwords(word: str) -> list[int]:
    marked = f"<{word}>"
    parts = [marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))]
    return [bucket(p, BUCKETS) for p in parts]


def _crc_steps() -> np.ndarray:
    """The CRC-32 of every last byte, from its rule."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


CRC = _crc_steps()


def scores_of(scores: np.ndarray, words: list[str]) -> np.ndarray:
    """Mean score of the subwords of each word. Words of ASCII letters are hashed together,
    one pass for each length and byte; the others one by one."""
    out = np.zeros((len(words), scores.shape[1]))
    plain = [i for i, w in enumerate(words) if w.isascii()]
    marked = [f"<{words[i]}>" for i in plain]
    flat = np.frombuffer("".join(marked).encode(), np.uint8)
    lengths = np.array([len(m) for m in marked], np.int64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(marked)), lengths)
    total = scores[[bucket(m, BUCKETS) for m in marked]].astype(np.float64) if marked else np.zeros((0, scores.shape[1]))
    for n in GRAMS:
        crc = np.full(max(0, len(flat) - n + 1), 0xFFFFFFFF, np.uint32)
        for k in range(n):
            crc = CRC[(crc ^ flat[k : k + len(crc)]) & 255] ^ (crc >> 8)
        inside = np.flatnonzero(np.arange(len(crc)) + n <= ends[owner[: len(crc)]])
        met = scores[(~crc[inside] % BUCKETS).astype(np.int64)]
        for language in range(scores.shape[1]):
            total[:, language] += np.bincount(owner[inside], weights=met[:, language], minlength=len(marked))
    parts = 1 + sum(np.maximum(lengths - n + 1, 0) for n in GRAMS)
    out[plain] = total / parts[:, None]
    for i, word in enumerate(words):
        if not word.isascii():
            out[i] = scores[subwords(word)].mean(axis=0)
    return out


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and their shares: every word weighs the same, whatever its length."""
    words, counts = np.unique(np.array(words_of(text), dtype=object).astype(str), return_counts=True)
    lists = [subwords(w) for w in words]
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0)
    weights = np.repeat(counts / np.array([len(x) for x in lists]), [len(x) for x in lists])
    ids, place = np.unique(np.concatenate(lists), return_inverse=True)
    share = np.bincount(place, weights=weights)
    return ids, share / share.sum()


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores per bucket, bias) after SGD over the rows."""
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    layer, bias = rng.normal(0, 0.1, (WIDTH, n)), np.zeros(n)
    steps = max(1, EPOCHS * -(-len(rows) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            ids = np.concatenate([rows[i][0] for i in part])
            share = np.concatenate([rows[i][1] for i in part])
            lengths = [len(rows[i][0]) for i in part]
            owner = np.repeat(np.arange(len(part)), lengths)
            mean = segment_sums(embed[ids] * share[:, None], offsets(lengths))
            wrong = softmax(mean @ layer + bias)
            wrong[np.arange(len(part)), classes[part]] -= 1
            wrong /= len(part)
            pull = wrong @ layer.T
            layer -= rate * mean.T @ wrong
            bias -= rate * wrong.sum(axis=0)
            np.subtract.at(embed, ids, rate * share[:, None] * pull[owner] * len(part))
    return embed @ layer, bias


def calibrate(z: np.ndarray, classes: np.ndarray) -> tuple[float, float]:
    """(temperature, rejection score) from documents the training has not seen."""
    if not len(z):
        return 1.0, 0.0
    chances = lambda t: np.log(softmax(z / t)[np.arange(len(z)), classes] + 1e-12).mean()
    temperature = float(max(np.geomspace(0.05, 5, 60), key=chances))
    p = softmax(z / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == classes
    order = np.argsort(-score, kind="stable")
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION
    kept = np.nonzero(precise)[0]
    return temperature, float(score[order][kept[-1]]) if len(kept) else 1.0


class WordScores:
    """Language scores of the words a worker has met, as rows of one matrix."""

    def __init__(self, scores: np.ndarray):
        self.scores, self.rows, self.place = scores, np.zeros((0, scores.shape[1]), np.float32), {}

    def learn(self, texts: list[list[str]]) -> None:
        """Make room for the words of some texts and score those not met yet, all at once.
        The table is emptied between groups of texts when it is full, never inside one."""
        words = {w for text in texts if len(text) <= REMEMBERED for w in text}
        if len(self.place) + len(words) > REMEMBERED:
            self.rows, self.place = self.rows[:0], {}
        new = [w for w in words if w not in self.place]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.rows = np.concatenate([self.rows, scores_of(self.scores, new).astype(np.float32)])

    def mean(self, words: list[str]) -> np.ndarray:
        """Of the words of a text that was learnt; a text of very many words is folded and
        needs no room."""
        if len(words) > REMEMBERED:
            counts = Counter(words)
            return np.average(scores_of(self.scores, list(counts)), axis=0, weights=list(counts.values()))
        return self.rows[list(map(self.place.__getitem__, words))].mean(axis=0, dtype=np.float64)


def groups(lengths: list[int], most: int = 50_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many words together."""
    first = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(lengths):
        yield first, len(lengths)


class LanguageModel:
    """fit learns from text and lang of the learning fold; rows without a language are left
    out. Without any row every prediction is ``und``."""

    def __init__(self, languages: list[str], scores: np.ndarray, bias: np.ndarray, temperature: float, reject: float):
        self.languages, self.scores, self.bias = languages, scores, bias
        self.temperature, self.reject = temperature, reject

    @classmethod
    def fit(cls, docs: DataFrame) -> LanguageModel:
        known = docs.where(learning_fold(F.col("doc_id")) & F.col("lang").isNotNull())
        # row_number with a bound keeps PER_LANGUAGE rows per task and language ahead of the shuffle.
        nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id"))
        ids = known.select("doc_id", "lang", nth.alias("nth")).where(F.col("nth") <= PER_LANGUAGE)
        # At most PER_LANGUAGE ids a language.
        chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("lang", "nth", "text")

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = sorted((str(x["lang"]), x["nth"], x["text"] or "") for b in batches for x in b.to_pylist())
            names = sorted({lang for lang, _, _ in found})
            bags = [bag(text) for _, _, text in found]
            classes = np.array([names.index(lang) for lang, _, _ in found], dtype=int)
            back = np.array([nth % HELD_BACK == 0 for _, nth, _ in found], dtype=bool)
            scores, bias = train([b for b, held in zip(bags, back) if not held], classes[~back], len(names))
            z = np.array([share @ scores[ids] + bias for (ids, share), held in zip(bags, back) if held])
            temperature, reject = calibrate(z, classes[back])
            model = pickle.dumps((names, scores.astype("f4"), bias, temperature, reject))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

        learnt = chosen.repartition(1).mapInArrow(learn, "model binary").first()
        if learnt is None:  # nothing to learn from
            return cls([], np.zeros((0, 0)), np.zeros(0), 1.0, 1.0)
        return cls(*pickle.loads(learnt[0]))

    def predict(self, docs: DataFrame) -> DataFrame:
        """doc_id, lang_pred, score, accepted. A null text, or one without a letter, is
        ``und`` with score 0. accepted is false where the score does not reach the
        calibrated bound."""
        shared = docs.sparkSession.sparkContext.broadcast(self)

        def in_groups(batch: pa.RecordBatch, met: WordScores) -> Iterator[list[str]]:
            """The words of each text, their scores learnt some texts at a time."""
            texts = batch.column("text").to_pylist()
            for first, last in groups([len(t or "") // 6 for t in texts]):
                part = [words_of(t) for t in texts[first:last]]
                met.learn(part)
                yield from part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            met = WordScores(model.scores)
            for batch in batches:
                names, scores = [], []
                for words in in_groups(batch, met):
                    # A run may be of numbers that are no decimal digits, such as ½ and ①.
                    if not model.languages or not any(c.isalpha() for w in words for c in w):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    z = met.mean(words) + model.bias
                    p = softmax(z / model.temperature)
                    names.append(model.languages[int(p.argmax())])
                    scores.append(float(p.max()))
                known = [n != UNKNOWN and s >= model.reject for n, s in zip(names, scores)]
                columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(known, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "accepted"])

        narrow = docs.select("doc_id", "text")
        return narrow.mapInArrow(run, keyed(docs, "lang_pred string, score double, accepted boolean"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    found = LanguageModel.fit(docs).predict(docs)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")

"""Substring deduplication: a count-min prefilter, then exact groups of what it lets through.

A window is 50 consecutive words of one document. Counting every window would shuffle
several times the corpus, so windows are counted through their anchor: the least hash
among the runs of 25 words inside the window. Equal windows have equal anchors, and
neighbouring windows mostly share one (about 13 windows an anchor), so the sketch counts
an anchor once per stretch of windows that has it. The sketch's estimate of an anchor is at
least the number of documents with any of its windows: no repeated window is lost.

The second pass reads the texts again and takes the stretches whose anchor is estimated
repeated. Exact groups are made of digests (128 bits) in two steps, largest pieces first.
Whole stretches are grouped, map-side first, so a passage in a third of all documents is
one row per task: a stretch that a smaller document also has goes as a whole, and its
windows need no row of their own. What is left is one document per distinct stretch. Only
where one anchor has several distinct stretches (around an edit, or where a shared passage
begins and ends) can a window still have a smaller owner: those windows alone are grouped.
Owners return in joins with one unique side, which adaptive execution can split. Only the
documents with candidates carry their words along; the others are final in the second pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import sketch
from carelake.llm.common import keyed, stored, table
from carelake.llm.wordhash import WordHasher, canonical, pieces, sliding_min

WINDOW = 50
ANCHOR_PER_BYTES = 75  # one anchor in about so many bytes of prose; sets the sketch's width

_STRETCHES = pa.list_(pa.struct([(n, pa.int64()) for n in ("place", "anchor", "a", "b")]))
LENGTH_BITS = 20  # of a stretch, packed with its first word; a longer one is cut


def window_anchors(hasher: WordHasher, texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, first word in the text, anchor) of every window of the texts."""
    words, counts = hasher.words(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    part = max(1, window // 2)
    anchors = sliding_min(hasher.runs(words, part), window - part + 1)
    inside = np.flatnonzero(owner[:n] == owner[window - 1 :])
    first = np.concatenate([[0], np.cumsum(counts)])[owner[inside]]
    return owner[inside], inside - first, anchors[inside]


def stretches(owner: np.ndarray, start: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Indices of the windows where a stretch of one anchor and one text begins."""
    begins = np.ones(len(anchors), bool)
    begins[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    begins |= start % (1 << LENGTH_BITS - 1) == 0
    return np.flatnonzero(begins)


def find_candidates(spark: SparkSession, docs: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, kept_sha256 (of all words), text_key, words (where there are
    candidates) and stretches: place (first word and number of windows), anchor, digest."""
    texts = docs.select("doc_id", "text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = sketch.width_for(size // ANCHOR_PER_BYTES)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        hasher = WordHasher()
        for batch in batches:
            plain = [canonical(t.as_py()) for t in batch.column(0)]
            for first, last in pieces(plain):
                owner, start, keys = window_anchors(hasher, plain[first:last], window)
                yield keys[stretches(owner, start, keys)]

    bits = spark.sparkContext.broadcast(sketch.repeated(texts.select("text"), anchors, width))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            plain = [canonical(t.as_py()) for t in batch.column("text")]
            for first, last in pieces(plain):
                part = plain[first:last]
                owner, start, keys = window_anchors(hasher, part, window)
                at = stretches(owner, start, keys)
                n = np.diff(np.append(at, len(keys)))
                hit = sketch.estimated_twice(bits.value, width, keys[at])
                at, n = at[hit], n[hit]
                yield _candidate_rows(batch.column("doc_id").slice(first, last - first), part, owner[at], start[at], n, keys[at], window)

    fields = (
        "n_words long, kept_sha256 string, text_key int, words binary, "
        "stretches array<struct<place: long, anchor: long, a: long, b: long>>"
    )
    return stored(spark, texts.mapInArrow(candidates, keyed(docs, fields)), "window-candidates")


def span_digests(text: bytes, first: np.ndarray, words: np.ndarray) -> list[bytes]:
    """Digest of so many words from each first word on."""
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    begins = np.concatenate([[0], gaps + 1])[first]
    ends = np.concatenate([gaps, [len(text)]])[first + words - 1]
    return [xxhash.xxh3_128_digest(text[b:e]) for b, e in zip(begins.tolist(), ends.tolist())]


def text_key(text: bytes) -> int:
    """Tells rows apart that share a doc_id."""
    return crc32(text) - (1 << 31)


def _candidate_rows(ids, texts, owner, start, n, anchors, window) -> pa.RecordBatch:
    lengths = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(lengths)
    digests: list[bytes] = []
    for text, end, many in zip(texts, ends, lengths):
        if many:
            mine = slice(end - many, end)
            digests += span_digests(text, start[mine], n[mine] + window - 1)
    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    fields = [start << LENGTH_BITS | n, anchors.view(np.int64), halves[:, 0], halves[:, 1]]
    listed = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], ends]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(f) for f in fields], names=["place", "anchor", "a", "b"]),
    )
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([t.count(b" ") + 1 if t else 0 for t in texts], pa.int64()),
            pa.array([sha256(t).hexdigest() for t in texts], pa.string()),
            pa.array([text_key(t) for t in texts], pa.int32()),
            pa.array([t if many else None for t, many in zip(texts, lengths)], pa.binary()),
            listed.cast(_STRETCHES),
        ],
        ["doc_id", "n_words", "kept_sha256", "text_key", "words", "stretches"],
    )


def judge_stretches(found: DataFrame) -> DataFrame:
    """doc_id, text_key, gone (places of stretches that a smaller document has whole) and
    open (places of stretches whose windows need a look of their own)."""
    single = found.select("doc_id", "text_key", F.explode("stretches").alias("s")).select("doc_id", "text_key", "s.*")
    key = ["anchor", "a", "b"]
    owners = single.groupBy(*key).agg(F.min("doc_id").alias("owner"))
    several = owners.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", F.lit(True).alias("several"))
    told = single.join(owners, key).where("doc_id >= owner").join(several, "anchor", "left")
    gone = F.col("doc_id") > F.col("owner")
    return (
        told.where(gone | F.col("several"))
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_set(F.when(gone, F.col("place"))).alias("gone"),
            F.collect_set(F.when(~gone, F.col("place"))).alias("open"),
        )
    )


def open_windows(found: DataFrame, judged: DataFrame, window: int) -> DataFrame:
    """doc_id, text_key, start and digest (a, b) of every window of the open stretches."""
    texts = found.select("doc_id", "text_key", "words").join(judged.where("size(open) > 0").select("doc_id", "text_key", "open"), ["doc_id", "text_key"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                places = np.array(batch.column("open")[i].as_py(), np.int64)
                n = places & (1 << LENGTH_BITS) - 1
                first = np.repeat(places >> LENGTH_BITS, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                digests = span_digests(batch.column("words")[i].as_py(), first, np.full(len(first), window))
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                same = lambda c: batch.column(c).slice(i, 1).take(pa.array(np.zeros(len(first), np.int32)))  # noqa: B023, E731
                columns = [same("doc_id"), same("text_key"), pa.array(first, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "start", "a", "b"])

    return texts.mapInArrow(windows, keyed(found, "text_key int, start int, a long, b long"))


def cut(words: list[bytes], places: list[tuple[int, int]]) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Words outside the places (first word, number of words), and the removed spans as
    (first word, word after the last)."""
    spans: list[tuple[int, int]] = []
    for first, n in sorted(places):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], first + n))
        else:
            spans.append((first, first + n))
    kept, at = [], 0
    for first, after in spans:
        kept += words[at:first]
        at = after
    return kept + words[at:], spans


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (first word, word after the last).

    A word goes if a window that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input. Null, empty and blank texts have no words;
    texts under 50 words keep all. A null doc_id is neither smaller nor larger than another,
    so its row keeps its words and takes none. Rows that share a doc_id take nothing from each
    other; each gives a row. Extra columns are ignored; an empty table gives an empty result.
    """
    found = find_candidates(spark, docs, window)
    judged = stored(spark, judge_stretches(found), "window-stretches")
    single = stored(spark, open_windows(found, judged, window), "windows")
    owners = (
        single.groupBy("a", "b")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last")
        .select("a", "b", "owner")
    )
    key = ["doc_id", "text_key"]
    removed = (
        single.join(owners, ["a", "b"]).where("doc_id > owner").groupBy(*key).agg(F.collect_set("start").alias("starts"))
    )
    told = (
        found.select(*key, "n_words", "kept_sha256", "words")
        .join(judged.select(*key, "gone"), key, "left")
        .join(removed, key, "left")
        .select("doc_id", "n_words", "kept_sha256", "words", "gone", "starts")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n_words, digests, texts, gone, starts = (batch.column(i) for i in range(6))
            n_removed, sums, spans = [], digests.to_pylist(), []
            for i in range(batch.num_rows):
                whole = [(p >> LENGTH_BITS, p & (1 << LENGTH_BITS) - 1) for p in gone[i].as_py() or ()]
                places = [(first, n + window - 1) for first, n in whole] + [(s, window) for s in starts[i].as_py() or ()]
                if not places:
                    n_removed.append(0)
                    spans.append([])
                    continue
                kept, out = cut(texts[i].as_py().split(b" "), places)
                n_removed.append(sum(after - first for first, after in out))
                sums[i] = sha256(b" ".join(kept)).hexdigest()
                spans.append([{"first": f, "after": a} for f, a in out])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
            columns = [ids, n_words, pa.array(n_removed, pa.int64()), pa.array(sums, pa.string()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    fields = "n_words long, n_removed long, kept_sha256 string, spans array<struct<first: int, after: int>>"
    return told.mapInArrow(finish, keyed(docs, fields))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, table(spark, sf_dir, "documents"))


#: Every window as a row: for small tables.
ORACLE = r"""
with words as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
windows as (
  select doc_id, i, md5_number(array_to_string(w[i:i + 49], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from words) x),
owners as (select h, min(doc_id) as first from windows group by h having min(doc_id) < max(doc_id)),
gone as (select doc_id, i from windows join owners using (h) where first < doc_id),
placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words),
marked as (
  select p.doc_id, p.i, word, count(g.i) over (partition by p.doc_id order by p.i rows between 49 preceding and current row) > 0 as covered
  from placed p left join gone g on g.doc_id = p.doc_id and g.i = p.i),
kept as (
  select doc_id, count(*) filter (covered) as n_removed, string_agg(word, ' ' order by i) filter (not covered) as text from marked group by doc_id),
stretches as (
  select doc_id, min(i) - 1 as first, max(i) as after
  from (select doc_id, i, i - row_number() over (partition by doc_id order by i) as stretch from marked where covered) x
  group by doc_id, stretch),
spans as (select doc_id, list({'first': first::int, 'after': after::int} order by first) as spans from stretches group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256,
  coalesce(spans, []::struct(first int, after int)[]) as spans
from words left join kept using (doc_id) left join spans using (doc_id)
"""

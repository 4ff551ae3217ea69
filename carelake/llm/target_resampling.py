"""Target-distribution importance resampling over hashed word features.

Every document is weighed by how much likelier its hashed words are in a target corpus
than among the documents, a keyed Gumbel draw is added, and the highest scores are drawn:
a sample without replacement in proportion to the weights.

1. Bucket counts of both corpora are added up per task in an array and summed by bucket;
   the gains of all buckets are one array (10,000 numbers), sent to the scoring tasks.
2. The cutoff among all scores is selected by weighted medians of medians: each task gives
   the median key of its remaining rows and their number, the driver takes the weighted
   median of these, and the next pass counts what lies above it. A quarter of the remaining
   rows at least is discarded each time, from either end, until the cutoff key is known.
3. Only the winners are sorted: by range, in parallel, each range numbered on from the last.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import keyed, lower_ascii, stored, table
from carelake.llm.linear import Table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MIN_WORDS, PERCENT, SEED = 20, 10, "2024"
PIECE = 1 << 20  # words counted before an array is brought up to date
SMALL = 2_000  # remaining rows that are looked at one by one
SHRUNK = 8  # the remaining rows are written anew when they are so many times fewer
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

Key = tuple[int, int, int, int]
KEY = ["worse", "no_id", "id", "digest"]  # ascending: the best row first


def hashed(text: str | None, word: regex.Pattern, buckets: Table) -> np.ndarray:
    """Buckets of the words of a text, one for each occurrence."""
    found = word.findall((text or "").translate(LOWER) if text and not text.islower() else text or "")
    return np.fromiter((buckets[w] for w in found), np.int64, len(found))


def _tools(size: int) -> tuple[regex.Pattern, Table]:
    return regex.compile(WORDS), Table(lambda w: crc32(w.encode("utf-8", "surrogatepass")) % size)


def bucket_counts(texts: DataFrame, size: int = BUCKETS) -> np.ndarray:
    """Occurrences of words per bucket over all rows of texts (text); null: none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, buckets = _tools(size)
        total = np.zeros(size, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(hashed(text, word, buckets), minlength=size)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    summed = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in summed.collect():  # one row a bucket
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, per bucket, rounded down."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s_all + size)) / ((corpus + 1.0) * (t_all + size))
    return np.array([floor(1000 * log(r)) for r in ratio.tolist()], np.int64)


def score_documents(docs: DataFrame, gain: np.ndarray, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and digest (of the text) of every row of docs."""
    size = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, buckets = _tools(size)
        for batch in batches:
            found = [hashed(text, word, buckets) for text in batch.column(1).to_pylist()]
            n = [len(f) for f in found]
            weight = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_features", "weight", "digest"])

    weighed = docs.select("doc_id", "text", F.xxhash64("text").alias("digest")).mapInArrow(
        weigh, keyed(docs, "n_features long, weight long, digest long")
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    draw = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.select("doc_id", "n_features", "weight", (F.col("weight") + draw).cast("long").alias("score"), "digest")


def _sorted_keys(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Keys in order, one row each."""
    columns = [batch.column(name).to_numpy() for name in KEY]
    return np.stack(columns, axis=1)[np.lexsort(columns[::-1])]


def _place(keys: np.ndarray, key: Key, right: bool = False) -> int:
    """How many sorted keys come before the key (right: or equal it)."""
    low, high = 0, len(keys)
    while low < high:
        middle = (low + high) // 2
        at = tuple(keys[middle].tolist())
        low, high = (middle + 1, high) if at < key or right and at == key else (low, middle)
    return low


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The key at which the sizes of the parts, taken in key order, reach one half."""
    medians = sorted(medians)
    half = sum(n for _, n in medians) / 2
    return next(key for (key, _), done in zip(medians, accumulate(n for _, n in medians)) if done >= half)


def cutoff_key(spark: SparkSession, keys: DataFrame, k: int) -> Key | None:
    """The k-th smallest of the keys (columns KEY, long, never null); None if k is 0.

    The driver holds a few numbers per task and at most SMALL keys."""
    if k < 1:
        return None
    low: Key | None = None  # what remains lies beyond low and before high
    high: Key | None = None
    pivot: Key | None = None
    written = remaining = None

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the remaining keys of a task: on each side of the pivot (0: before, 1: equal,
        2: beyond), how many and their median."""
        held = list(batches)
        rows = _sorted_keys(pa.Table.from_batches(held)) if held else np.zeros((0, 4), np.int64)
        first = _place(rows, low, True) if low else 0
        rows = rows[first : _place(rows, high) if high else len(rows)]
        cuts = [0, _place(rows, pivot), _place(rows, pivot, True), len(rows)] if pivot else [0, 0, 0, len(rows)]
        for side, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                median = rows[(a + b - 1) // 2].tolist()
                yield pa.RecordBatch.from_pydict({"side": [side], "n": [b - a], **{c: [v] for c, v in zip(KEY, median)}})

    fields = "side long, n long, " + ", ".join(f"{c} long" for c in KEY)
    while True:
        if remaining is not None and (remaining <= SMALL or remaining * SHRUNK <= written):
            keys = keys.where(_between(low, high))
            if remaining <= SMALL:
                return sorted(tuple(r) for r in keys.collect())[k - 1]
            keys, written = stored(spark, keys, "selection"), remaining
        found = [(r.side, r.n, tuple(r[c] for c in KEY)) for r in keys.mapInArrow(survey, fields).collect()]
        sizes = Counter()
        for side, n, _ in found:
            sizes[side] += n
        if k <= sizes[0]:
            side, high = 0, pivot
        elif k <= sizes[0] + sizes[1]:
            return pivot
        else:
            side, low, k = 2, pivot, k - sizes[0] - sizes[1]
        remaining = sizes[side]
        written = written or remaining
        pivot = weighted_median([(key, n) for s, n, key in found if s == side])


def _key_order(key: Key, beyond: bool):
    """Rows whose key comes after the key (or before it)."""
    compare = (lambda c, v: F.col(c) > v) if beyond else (lambda c, v: F.col(c) < v)
    out = F.lit(False)
    for name, value in reversed(list(zip(KEY, key))):
        out = compare(name, value) | ((F.col(name) == value) & out)
    return out


def _between(low: Key | None, high: Key | None):
    return (_key_order(low, True) if low else F.lit(True)) & (_key_order(high, False) if high else F.lit(True))


def ranked(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with rank (1, 2, ...) in the order of columns, without one task for all."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = pa.array(np.arange(seen + 1, seen + batch.num_rows + 1))
            seen += batch.num_rows
            arrays = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), place]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "part", "place"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes) + ", part int, place long"
    spread = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = stored(spark, spread.mapInArrow(number, schema), "ranked")
    sizes = {r.part: r.n for r in numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one a task
    before = dict(zip(sorted(sizes), accumulate([0, *(sizes[p] for p in sorted(sizes))])))
    offset = F.lit(0) if not before else F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("part"))
    return numbered.select(*rows.columns, (F.col("place") + offset).cast("long").alias("rank"))


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED
) -> DataFrame:
    """One row per row of docs (doc_id, integer; text; others are left out): doc_id,
    n_features, weight, score and rank among the drawn (null: not drawn).

    Of the N rows with min_words words or more, percent * N / 100 are drawn, rounded down:
    the highest scores, ties to the smaller doc_id. A null or empty text has no words and
    weight 0. A row without id is scored as if its id were empty and comes after all ids in
    a tie. Rows that share an id are separate rows; ties between them go by a hash of the
    text, and equal rows are interchangeable. Empty docs give no rows, an empty target only
    smoothed shares."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    weighed = score_documents(docs, gain, seed).select(
        "*",
        (-F.col("score")).alias("worse"),
        F.col("doc_id").isNull().cast("long").alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
    )
    scored = stored(spark, weighed, "scored")
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    keys = scored.where(F.col("n_features") >= min_words).select(*KEY)
    k = percent * keys.count() // 100
    last = cutoff_key(spark, keys, k)
    if last is None:
        return scored.select(*columns, unranked)
    reached = (F.col("n_features") >= min_words) & ~_key_order(last, True)
    winners = ranked(spark, scored.where(reached).select(*columns, *KEY), KEY)
    # Equal rows at the cutoff can be more than are still to be drawn; their ranks say which.
    won = winners.select(*columns, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return won.unionByName(scored.where(~reached).select(*columns, unranked))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn to look like the benchmark texts."""
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with steps as (
  select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as entry
  from (select unnest(range(256)) as i)),
crc as (select list(entry order by i) as t from steps),
words as (
  select 'd' as side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from documents
  union all
  select 't', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
spelt as (select word, hex(encode(word)) as code from (select distinct word from words)),
bucket as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(len(code) // 2),
      lambda i: ('0x' || substr(code, 2 * i + 1, 2))::bigint)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as b
  from spelt, crc),
counts as (
  select b, count(*) filter (side = 'd') as s, count(*) filter (side = 't') as t from words join bucket using (word) group by b),
gain as (
  select b, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as g
  from counts),
weighed as (
  select doc_id, count(*) as n, floor(sum(g) / count(*))::bigint as w
  from words join bucket using (word) join gain using (b) where side = 'd' group by doc_id),
scored as (
  select d.doc_id, coalesce(n, 0) as n_features, coalesce(w, 0) as weight,
    coalesce(w, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint + 0.5)::double / 4294967296)))::bigint as score
  from documents d left join weighed using (doc_id)),
placed as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_features >= 20) over () * 10 // 100 as k from scored)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= k then place end as rank from placed
"""

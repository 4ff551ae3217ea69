"""N-gram Jaccard join by T-occurrence search (DivideSkip), and its components.

A document is the set of its distinct 5-word shingles. Two link when
100 * intersection >= 80 * union.

1. One shared order of shingles puts those that occur once first, the others by the hash of
   their least word and then by their own, so that the first shingles come from few
   passages. Similar sets must share one of their first n - ceil(0.8 n) + 1 shingles in any
   shared order, and a shingle that occurs once has no partner: a document with enough
   shingles of its own has no candidates at all, and passages that thousands of otherwise
   different documents share make none. Such documents go first: some of all shingles meet
   their like in a shuffle, at any size of the table, then all shingles of one set of each
   class that is left. What remains has its first shingles from a sketch of bounded width.
2. Equal sets are one class with one representative.
3. Candidates are searched in blocks: a query and the sets that share one of its first
   shingles. In a block the query's inverted lists are divided: the short ones are
   heap-merged, sets found often enough are looked up in the long ones by binary search,
   and those that reach the required overlap are links. First every set is searched with
   the one leader it shares most shingles with, which joins many near copies in a number
   of pairs that is linear in their number. Then all candidates still in different
   components are searched in tiles of two buckets of documents, so no link between
   components is missed and no pair is ever a row.

A block or tile has about BLOCK sets or BLOCK_SHINGLES shingles a side, whichever is less:
a larger group is dealt out over several.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from math import log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from carelake.llm import sketch
from carelake.llm.common import keyed, small_batches, stored, table
from carelake.llm.components import components
from carelake.llm.wordhash import WordHasher, canonical, mixed, pieces, sliding_min

SIZE = 5  # words of a shingle
PERCENT = 80
BLOCK = 768
BLOCK_SHINGLES = 400_000  # their sets and inverted lists take about 100 MB
TURNS = 1  # of leaders; every pair that they leave open is searched afterwards
WORD_BYTES = 6  # bytes of a word and its blank; sets the sketch's width
MOST_CELLS = 1 << 28  # one row of 32 MB of bits
SHARE = 0.3  # of the shingles that are met by hash: more than first shingles are
CHUNK, SHARD = 1_000_000, 2_000_000  # shingles sent together, and met together in a task
SEVERAL = 0xFFFF  # instead of the number of a set, and most sets of a chunk
ANCHOR_BITS = np.uint64(16)  # first bits of a shingle's hash, from its least word: neighbours stay together
ANCHOR = ~(~np.uint64(0) >> ANCHOR_BITS)
MU = 0.0085  # weight of a probe against a merge step in the number of long lists


def shingle_sets(hasher: WordHasher, texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text (lower-cased words, single spaces)."""
    words, counts = hasher.words(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    whole = hasher.runs(words, size)
    if len(whole):
        whole = sliding_min(words, size) & ANCHOR | whole >> ANCHOR_BITS
    inside = owner[: len(whole)] == owner[size - 1 :] if len(whole) else np.zeros(0, bool)
    ends = np.cumsum(np.maximum(counts - size + 1, 0))
    parts = np.split(whole[inside], ends[:-1])
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        parts[i] = np.array([xxhash.xxh3_64_intdigest(texts[i])], np.uint64)
    return [np.unique(p) for p in parts]


def all_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sets of many texts, hashed a few at a time."""
    hasher = WordHasher()
    return [s for first, last in pieces(texts) for s in shingle_sets(hasher, texts[first:last])]


def plain(text: str | bytes | None) -> bytes:
    """The words of a text; bytes are words already."""
    return text if isinstance(text, bytes) else canonical(text).lower()  # of bytes: A-Z alone


def first_shingles(shingles: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Those of the first n - ceil(0.8 n) + 1 in the shared order that may have a partner."""
    n = len(shingles)
    length = n - -(-PERCENT * n // 100) + 1 if n else 0
    return shingles[often][: max(0, length - int((~often).sum()))]


def required(n: int, m: int) -> int:
    """Least intersection of linked sets of n and m."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


class Index:
    """Inverted lists of some sets: for each shingle the ascending numbers of its sets."""

    def __init__(self, sets: list[np.ndarray], members: list[int]):
        self.sets, self.lists = sets, {}
        for i in members:
            for shingle in sets[i].tolist():
                self.lists.setdefault(shingle, []).append(i)

    def t_occurrence(self, query: np.ndarray) -> list[int]:
        """Numbers of the sets that link with the query, by DivideSkip."""
        n = len(query)
        lists = sorted((x for x in map(self.lists.get, query.tolist()) if x), key=len)
        least = -(-PERCENT * n // 100)  # required of the smallest set that can link
        if not n or len(lists) < least:
            return []
        n_long = min(least - 1, int(least / (MU * log2(max(2, len(lists[-1]))) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        found = []
        for i, met in groupby(heapq.merge(*short)):
            count, m = sum(1 for _ in met), len(self.sets[i])
            if count < least - n_long or 100 * min(n, m) < PERCENT * max(n, m):
                continue
            goal = required(n, m)
            for left, entries in zip(range(len(long), 0, -1), reversed(long)):
                if count >= goal or count + left < goal:
                    break
                at = bisect_left(entries, i)
                count += at < len(entries) and entries[at] == i
            if count >= goal:
                found.append(i)
        return found


def chunk_entries(sets: list[np.ndarray], share: float, shards: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(place, what is left of the hash, number of the set) of this share of the shingles. One that
    several of the sets have comes once, without a set: it is met again, whatever others hold."""
    hashes, owner = mixed(np.concatenate(sets), 3), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    some = (hashes & np.uint64(255)) < np.uint64(round(256 * share))
    order = np.argsort(hashes[some], kind="stable")
    hashes, owner = hashes[some][order], owner[some][order]
    new = np.ones(len(hashes) + 1, bool)
    new[1:-1] = hashes[1:] != hashes[:-1]
    owner = np.where(new[1:], owner, SEVERAL)[new[:-1]].astype("<u2")
    hashes = hashes[new[:-1]]
    places = (hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    left = (hashes >> np.uint64(8)).astype("<u4")  # bits that neither share nor place follow
    found, starts = np.unique(places, return_index=True)
    for place, first, last in zip(found.tolist(), starts, [*starts[1:], len(places)]):
        yield place, left[first:last].tobytes(), owner[first:last].tobytes()


def met_once(entries: list[tuple[int, bytes, bytes]]) -> tuple[list[int], list[bytes]]:
    """Of all entries (chunk, hashes, sets) of a place: the chunks, and the sets of the hashes that one set alone has."""
    hashes = np.concatenate([np.frombuffer(h, "<u4") for _, h, _ in entries])
    owner = np.concatenate([np.frombuffer(s, "<u2") for _, _, s in entries])
    order = np.argsort(hashes, kind="stable")
    change = np.ones(len(hashes) + 1, bool)
    change[1:-1] = hashes[order[1:]] != hashes[order[:-1]]
    once = np.sort(order[change[1:] & change[:-1]])
    once = once[owner[once] != SEVERAL]
    cuts = np.searchsorted(once, np.cumsum([len(s) // 2 for _, _, s in entries])[:-1])
    return [chunk for chunk, _, _ in entries], [owner[part].tobytes() for part in np.split(once, cuts)]


def open_sets(spark: SparkSession, texts: DataFrame, share: float) -> DataFrame:
    """doc_id, n_shingles, set digest (a, b), and whether another of these texts (doc_id, text) may link.

    The order here puts the shingles of this share of all (by hash) that one text alone has before
    all others. A text with as many of them as its first shingles links with nothing. Nothing is
    held or sent in one piece: chunks of texts send six bytes a shingle, by hash, to the place that
    meets all its like, and get two for each shingle that they alone have.
    """
    small_batches(spark)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = int(share * size / WORD_BYTES / SHARD) + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, chunk = WordHasher(), TaskContext.get().partitionId() << 33
        held, ids, size = [], [], 0

        def cut() -> Iterator[pa.RecordBatch]:
            nonlocal chunk
            names = pa.concat_arrays(ids)
            for first in range(0, len(held), SEVERAL):
                sets = held[first : first + SEVERAL]
                digests = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
                counts = np.array([len(s) for s in sets], "<i8").tobytes()
                rows = [(-1 - chunk % shards, counts, digests), *chunk_entries(sets, share, shards)]
                own = names.slice(first, len(sets))
                heads = pa.ListArray.from_arrays(pa.array([0] + [len(own)] * len(rows), pa.int32()), own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), heads]
                    + [pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)],
                    ["place", "chunk", "ids", "left", "owners"],
                )
                chunk += 1

        for batch in batches:
            words = [plain(t.as_py()) for t in batch.column("text")]
            for first, last in pieces(words):
                sets = shingle_sets(hasher, words[first:last])
                held += sets
                ids.append(batch.column("doc_id").slice(first, last - first))
                size += sum(map(len, sets))
                if size > CHUNK:
                    yield from cut()
                    held, ids, size = [], [], 0
        if held:
            yield from cut()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chunk", "ids", "left", "owners"]
        kind = None

        def answer(entries: list) -> pa.RecordBatch:
            chunks, owners = met_once(entries)
            none = [pa.nulls(len(chunks), kind), pa.nulls(len(chunks), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), *none, pa.array(owners, pa.binary())], names)

        place, entries = None, []
        for batch in batches:
            kind = batch.column("ids").type
            places = batch.column("place").to_pylist()
            heads = sum(p < 0 for p in places)  # they come first
            if heads:
                yield pa.RecordBatch.from_arrays([batch.column(n).slice(0, heads) for n in names], names)
            rows = zip(places[heads:], *(batch.column(n).slice(heads).to_pylist() for n in ("chunk", "left", "owners")))
            for now, *entry in rows:
                if now != place and entries:
                    yield answer(entries)
                    entries = []
                place = now
                entries.append(entry)
        if entries:
            yield answer(entries)

    def decide(chunk: pa.Table) -> pa.Table:
        head = pc.is_valid(chunk.column("left"))
        given = chunk.filter(head)
        ids = pa.concat_arrays([x.flatten() for x in given.column("ids").chunks])
        n = np.frombuffer(given.column("left")[0].as_py(), "<i8")
        halves = np.frombuffer(given.column("owners")[0].as_py(), "<i8").reshape(-1, 2)
        own = np.frombuffer(b"".join(chunk.filter(pc.invert(head)).column("owners").to_pylist()), "<u2")
        first = n + (-PERCENT * n // 100) + 1
        may = (n > 0) & (np.bincount(own, minlength=len(n)) < first)
        columns = [ids, pa.array(n), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(may)]
        return pa.Table.from_arrays(columns, ["doc_id", "n_shingles", "a", "b", "open"])

    listed = StructField("ids", ArrayType(texts.schema["doc_id"].dataType))
    sent = StructType([*StructType.fromDDL("place int, chunk long"), listed, *StructType.fromDDL("left binary, owners binary")])
    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = texts.select("doc_id", "text").mapInArrow(send, sent).repartition(parts, "place").sortWithinPartitions("place")
    answers = met.mapInArrow(meet, StructType([f for f in sent if f.name != "place"]))
    decided = answers.groupBy("chunk").applyInArrow(decide, keyed(texts, "n_shingles long, a long, b long, open boolean"))
    return stored(spark, decided, "shingle-sets")


def of_ids(spark: SparkSession, frame: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the frame whose id (the first column, as in ids) is among ids, and a few others.
    Tasks get a sketch of the ids, so that no row of the frame is moved."""
    width = sketch.width_for(ids.count(), most=MOST_CELLS)
    hashed = lambda column: np.asarray(column).view(np.uint64)
    every = lambda batches: (hashed(batch.column(0)).repeat(2) for batch in batches)
    bits = spark.sparkContext.broadcast(sketch.repeated(ids.select(F.xxhash64(ids.columns[0])), every, width, 1))

    def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = sketch.estimated_twice(bits.value, width, hashed(batch.column("hashed")))
            yield batch.drop_columns(["hashed"]).filter(pa.array(met))

    return frame.withColumn("hashed", F.xxhash64(frame.columns[0])).mapInArrow(among, frame.schema)


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set digest (a, b) and the words of documents (doc_id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            words = [plain(t.as_py()) for t in batch.column("text")]
            for first, last in pieces(words):
                sets = shingle_sets(hasher, words[first:last])
                digests = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
                halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
                numbers = [pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
                columns = [batch.column("doc_id").slice(first, last - first), *numbers, pa.array(words[first:last], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "a", "b", "words"])

    return docs.select("doc_id", "text").mapInArrow(rows, keyed(docs, "n_shingles long, a long, b long, words binary"))


def with_first(spark: SparkSession, heads: DataFrame) -> DataFrame:
    """doc, n and the first shingles that may have a partner, of sets (doc, n, words)."""
    size = heads.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    width = sketch.width_for(size // WORD_BYTES, 1, MOST_CELLS)

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        hasher = WordHasher()
        for batch in batches:
            words = batch.column(0).to_pylist()
            for first, last in pieces(words):
                yield np.concatenate(shingle_sets(hasher, words[first:last]))

    bits = spark.sparkContext.broadcast(sketch.repeated(heads.select("words"), every, width, 1))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            words = batch.column("words").to_pylist()
            for first, last in pieces(words):
                sets = shingle_sets(hasher, words[first:last])
                flat = sketch.estimated_twice(bits.value, width, np.concatenate(sets))
                often = np.split(flat, np.cumsum([len(s) for s in sets])[:-1])
                start = pa.array([first_shingles(s, o).view(np.int64) for s, o in zip(sets, often)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(first, last - first) for k in ("doc", "n")), start], ["doc", "n", "first"]
                )

    return stored(spark, heads.select("doc", "n", "words").mapInArrow(rows, "doc long, n long, first array<long>"), "first-shingles")


def blocks(documents: Column, shingles: Column) -> Column:
    """Blocks to deal so many documents into, whose sets have so many shingles together."""
    return (F.greatest(documents / BLOCK, shingles / BLOCK_SHINGLES) + 1).cast("int")


def search_blocks(spark: SparkSession, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Links (left, right) among the pairs (query, doc), found block by block."""
    sized = pairs.join(words.select("doc", "n"), "doc")
    ranked = sized.groupBy("query").agg(blocks(F.count("*"), F.sum("n")).alias("parts"))
    dealt = pairs.join(ranked, "query").select("query", "doc", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"))
    queries = dealt.select("query", "part").distinct().select("query", "part", F.col("query").alias("doc"))
    full = dealt.select("query", "part", "doc").unionByName(queries).join(words.select("doc", "words"), "doc")

    def search(block: pa.Table) -> pa.Table:
        query = block.column("query")[0].as_py()
        ids, texts = block.column("doc").to_pylist(), block.column("words").to_pylist()
        sets = all_sets(texts)
        at = ids.index(query)
        found = Index(sets, [i for i in range(len(ids)) if i != at]).t_occurrence(sets[at])
        return pa.table({"left": pa.array([query] * len(found), pa.int64()), "right": pa.array([ids[k] for k in found], pa.int64())})

    return full.groupBy("query", "part").applyInArrow(search, "left long, right long")


def open_lists(lists: DataFrame, grouped: DataFrame | None) -> DataFrame:
    """The lists (shingle, doc, n, component) that hold more than one component."""
    if grouped is not None:
        named = grouped.select(F.col("node").alias("doc"), F.col("component").alias("now"))
        lists = lists.join(named, "doc", "left").withColumn("component", F.coalesce("now", "component")).drop("now")
    mixed = lists.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return lists.join(mixed.select("shingle"), "shingle", "left_semi").select("shingle", "doc", "n", "component")


FITS = f"100 * least(n, lead_n) >= {PERCENT} * greatest(n, lead_n) and component <> lead_component"


def leader_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """At most one pair (query, doc) per doc: the leader it shares most lists with. A
    list's leader is the doc that a hash of this turn puts first; the first turn takes the
    smallest id."""
    rank = F.xxhash64(F.lit(turn), "doc") if turn else F.col("doc")
    lead = F.min(F.struct(rank.alias("rank"), "doc", "n", "component")).alias("lead")
    leaders = lists.groupBy("shingle").agg(lead).select(
        "shingle", F.col("lead.doc").alias("query"), F.col("lead.n").alias("lead_n"), F.col("lead.component").alias("lead_component")
    )
    votes = lists.join(leaders, "shingle").where(FITS).groupBy("doc", "query").agg(F.count("*").alias("votes"))
    best = votes.groupBy("doc").agg(F.max(F.struct("votes", (-F.col("query")).alias("minus"))).alias("top"))
    return best.select((-F.col("top.minus")).alias("query"), "doc")


def dealt_lists(spark: SparkSession, lists: DataFrame) -> DataFrame:
    """shingle, doc, n, component, bucket: the lists with the bucket of each document.

    Documents that lists connect are a family, dealt into buckets of about BLOCK by their
    longest list, which keeps those that share it together; a longer list is dealt on by
    document.
    """
    heads = lists.groupBy("shingle").agg(
        F.min("doc").alias("left"), F.count("*").alias("length"), blocks(F.count("*"), F.sum("n")).alias("cuts")
    )
    headed = stored(spark, lists.join(heads, "shingle"), "headed-lists")
    edges = headed.select("left", F.col("doc").alias("right")).distinct()
    family = components(spark, edges)
    longest = headed.groupBy("doc").agg(
        F.max(F.struct("length", "shingle", "cuts")).alias("longest"),
        F.max("n").alias("n"),
        F.max("component").alias("own"),  # one for each document
        F.collect_list("shingle").alias("shingles"),
    )
    sized = family.join(longest.select(F.col("doc").alias("node"), "n"), "node")
    sizes = sized.groupBy("component").agg(blocks(F.count("*"), F.sum("n")).alias("parts"))
    of_list = F.pmod(F.xxhash64("longest.shingle"), F.col("parts"))
    of_doc = F.pmod(F.xxhash64("doc"), F.col("longest.cuts"))
    dealt = (
        family.withColumnRenamed("node", "doc")
        .join(sizes, "component")
        .join(longest, "doc")
        .select(F.explode("shingles").alias("shingle"), "doc", "n", F.xxhash64("component", of_list, of_doc).alias("bucket"), F.col("own").alias("component"))
    )
    return stored(spark, dealt, "dealt-lists")


def tiles(spark: SparkSession, lists: DataFrame) -> DataFrame:
    """low, high, doc, bucket, component: which documents to search in which tile.

    A tile is two buckets (or one) with a list in common, and has the documents of those
    lists. A list's buckets are one array, which each of its rows gets, so the join makes a row
    for a row of the lists, however many buckets a list has. A document's equal arrays are one,
    and only the tiles they name become rows: for a group of g documents at most g * (g / BLOCK).
    """
    placed = dealt_lists(spark, lists)
    buckets = placed.groupBy("shingle").agg(F.array_sort(F.collect_set("bucket")).alias("others"))
    met = placed.join(buckets, "shingle").groupBy("doc").agg(
        F.max("bucket").alias("bucket"), F.max("component").alias("component"), F.collect_set("others").alias("others")
    )
    sent = met.select("doc", "bucket", "component", F.explode(F.array_distinct(F.flatten("others"))).alias("other"))
    return sent.select(F.least("bucket", "other").alias("low"), F.greatest("bucket", "other").alias("high"), "doc", "bucket", "component")


def linking_tiles(spark: SparkSession, lists: DataFrame) -> DataFrame:
    """As tiles, for lists of banded shingles, without the documents that cannot link in a tile.

    Of two linked sets of n and m, take the one whose first shingles end first in the shared
    order: all it has in common with the other lies in both's first shingles or among its last
    ceil(0.8 n) - 1. So the two share more than 0.8 / 1.8 * (n + m) - 0.8 * max(n, m) first shingles.
    A document is sent to another bucket only if as many of its lists in one band have
    documents of other components there, whose sizes lie between the least and greatest there.
    """
    placed = dealt_lists(spark, lists)
    there = placed.groupBy("shingle", F.col("bucket").alias("other")).agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    met = (
        placed.join(there, "shingle")
        .where("first <> component or last <> component")
        .groupBy("doc", "n", "component", "bucket", "other", F.expr("shingle & 1").alias("parity"))
        .agg(F.count("*").alias("shared"), F.min("least").alias("least"), F.max("most").alias("most"))
    )
    share = PERCENT / 100
    needed = lambda m: share / (1 + share) * (F.col("n") + m) - share * F.greatest(F.col("n").cast("double"), m)
    ends = F.least(needed(F.greatest("least", F.col("n") * share)), needed(F.least("most", F.col("n") / share)))
    fits = f"100 * most >= {PERCENT} * n and {PERCENT} * least <= 100 * n"
    kept = met.where(fits).where(F.col("shared") > ends - 0.01)  # for rounding
    sent = kept.select(
        F.least("bucket", "other").alias("low"), F.greatest("bucket", "other").alias("high"), "doc", "bucket", "component"
    ).distinct()
    sent = stored(spark, sent, "sent")
    sides = sent.groupBy("low", "high").agg(F.min("bucket").alias("one"), F.max("bucket").alias("two"))
    return sent.join(sides.where("one = low and two = high"), ["low", "high"], "left_semi")


def search_tiles(tiled: DataFrame, words: DataFrame) -> DataFrame:
    """Links (left, right) that join components, found tile by tile: every document of one
    bucket is searched in the inverted lists of the other. The sets of the component most
    frequent there have lists of their own, which its own members need not search."""

    def search(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by("doc")
        ids, component, bucket, texts = (tile.column(c).to_pylist() for c in ("doc", "component", "bucket", "words"))
        low, high = tile.column("low")[0].as_py(), tile.column("high")[0].as_py()
        sets = all_sets(texts)
        right = [i for i, b in enumerate(bucket) if b == high]
        parent = {c: c for c in component}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        main = Counter(component[i] for i in right).most_common(1)[0][0] if right else None
        of_main = Index(sets, [i for i in right if component[i] == main])
        of_rest = Index(sets, [i for i in right if component[i] != main])
        found = []
        for i, b in enumerate(bucket):
            if b != low:
                continue
            met = of_rest.t_occurrence(sets[i])
            if root(component[i]) != root(main):
                met += of_main.t_occurrence(sets[i])
            for k in met:
                x, y = root(component[i]), root(component[k])
                if x != y:
                    parent[x] = y
                    found.append((ids[i], ids[k]))
        return pa.table({"left": pa.array([a for a, _ in found], pa.int64()), "right": pa.array([b for _, b in found], pa.int64())})

    return tiled.join(words.select("doc", "words"), "doc").groupBy("low", "high").applyInArrow(search, "left long, right long")


def link_components(spark: SparkSession, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """component_id of every class (n_shingles, a, b) of equal open sets: the smallest doc_id
    of the classes that its links reach. A class is searched under a number of its own, so
    different texts under one id are different documents."""
    key = ["n_shingles", "a", "b"]
    classes = sets.where("doc_id is not null and open").groupBy(*key).agg(F.min("doc_id").alias("first_id"))
    # Numbered in the order of their first ids: of a group of copies the original is mostly
    # the first, and so leads the others.
    ordered = classes.repartitionByRange("first_id").sortWithinPartitions("first_id", *key)
    numbered = stored(spark, ordered.withColumn("doc", F.monotonically_increasing_id()), "class-numbers")
    texts = of_ids(spark, docs.select("doc_id", "text"), numbered.select("first_id"))
    found = sets_of(texts).join(numbered, key).where("doc_id = first_id").dropDuplicates([*key, "doc_id"])
    words = stored(spark, found.select("doc", F.col("n_shingles").alias("n"), "words"), "set-classes")
    # Among one set of each class, originals of exact copies have shingles of their own again.
    again = open_sets(spark, words.select(F.col("doc").alias("doc_id"), F.col("words").alias("text")), 1)
    words = stored(spark, of_ids(spark, words, again.where("open").select("doc_id")), "open-classes")
    heads = with_first(spark, words)
    # Sets that can link have sizes in the same band or in neighbouring ones, so each set
    # stands in the lists of its band and of the next: a shingle's list holds no other sizes.
    band = F.floor(F.log(F.col("n").cast("double")) / log(100 / PERCENT))
    banded = heads.select(F.explode("first").alias("one"), "doc", "n").withColumn("band", F.explode(F.array(band, band + 1)))
    # The last bit tells a document's two bands apart.
    listed = F.shiftleft(F.xxhash64("one", "band"), 1) + F.pmod("band", F.lit(2))
    lists = banded.select(listed.alias("shingle"), "doc", "n", F.col("doc").alias("component"))
    links = spark.createDataFrame([], "left long, right long")
    grouped = None
    for turn in range(TURNS):
        lists = stored(spark, open_lists(lists, grouped), "open-lists")
        pairs = stored(spark, leader_pairs(lists, turn), "leader-pairs")
        links = links.unionByName(stored(spark, search_blocks(spark, pairs, words), "leader-links"))
        grouped = components(spark, links)
    lists = stored(spark, open_lists(lists, grouped), "open-lists")
    tiled = stored(spark, linking_tiles(spark, lists), "tiles")
    grouped = components(spark, links.unionByName(stored(spark, search_tiles(tiled, words), "tile-links")))
    placed = numbered.join(grouped.withColumnRenamed("node", "doc"), "doc", "left").select(
        *key, "first_id", F.coalesce("component", "doc").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return placed.join(least, "component").select(*key, "component_id")


def ngram_jaccard(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links.

    Words are separated by the six blanks, A-Z lower-cased. With under five words the
    whole sequence is the one shingle; a null, empty or blank text has none, links with
    nothing and is its own component. Rows with a null doc_id link with nothing and have a
    null component. Rows that repeat a doc_id with the same words are one document given
    several times; with other words they are separate documents, each with its own links. Ids are whole numbers. Extra columns are ignored; an empty table gives
    an empty result.
    """
    sets = open_sets(spark, docs.select("doc_id", "text"), SHARE)
    key = ["n_shingles", "a", "b"]
    linked = F.col("doc_id").isNotNull() & F.col("open")
    return (
        sets.select("doc_id", *key, linked.alias("linked"))
        .join(link_components(spark, sets, docs), key, "left")
        .select("doc_id", "n_shingles", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(spark, table(spark, sf_dir, "documents"))


#: Every shared shingle of every pair: for small tables.
ORACLE = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
places as (
  select doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as i from words),
shingles as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s, len(w) < 5 as short from places),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
often as (select s, short from shingles group by all having count(*) > 1),
common as (select doc_id, md5_number(s || case when short then ' <' else '' end) as h from shingles join often using (s, short)),
joint as (select a.doc_id as l, b.doc_id as r, count(*) as k from common a join common b on a.h = b.h and a.doc_id <> b.doc_id group by all),
links as (
  select l, r from joint join sizes x on x.doc_id = l join sizes y on y.doc_id = r where 100 * k >= 80 * (x.n + y.n - k)),
reach as (select l, r from links union select reach.l, links.r from reach join links on reach.r = links.l),
smallest as (select l, min(r) as m from reach group by l)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id
from documents d left join sizes using (doc_id) left join smallest on d.doc_id = smallest.l
"""

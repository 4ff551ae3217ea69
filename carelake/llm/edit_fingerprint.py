"""Document fingerprints by a randomised edit embedding.

A walk copies a text's characters into an output string: at each output position the
current character is written, and a bit shared by all texts, drawn for that position and
character, says whether to go on to the next character. Two texts with few edits fall
back into step soon after each edit, so their outputs differ in few positions: edit distance
becomes Hamming distance. The bits repeat with a period, which makes the number of times
a character is written one table entry per (character class, position).

The fingerprint samples output positions, as many in each octave of the output's length,
and writes four bits of the character there as one hex digit. Likeness weighs the octaves
by their length, so it estimates the share of output positions that agree.

Only a text and its neighbour in the order of ids are needed together: documents are dealt
into ranges of ids (balanced by quantiles), the first of each range also goes to the range
that ends before it, and each range is read in order. The texts move once.

Bands sampled from the fingerprints name the pairs to verify, and the verified pairs make
classes of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import batched, chain
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from carelake.llm import sketch
from carelake.llm.common import keyed, small_batches, stored, table
from carelake.llm.components import components
from carelake.llm.ngram_jaccard import tiles
from carelake.llm.wordhash import mixed

CLASSES, PERIOD, SEED = 64, 4096, 5
PER_OCTAVE = 32  # sampled output positions in each octave
OCTAVES = 40
LANES, FEW = 512, 100  # texts walked side by side; with fewer left each is walked alone
PAD = 255
LOWEST = -(1 << 63)
MOST_CELLS = 1 << 30  # of the sketch of band keys, 128 MB of bits


def _walk_table() -> np.ndarray:
    """Times a character of a class is written from a position on: up to its next set bit."""
    bits = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    bits[:, ::16] = True
    steps = np.zeros((CLASSES, PERIOD), np.uint8)
    nearest = np.ones(CLASSES, np.uint8)
    for at in [*range(15, -1, -1), *range(PERIOD - 1, -1, -1)]:
        nearest = np.where(bits[:, at], 1, nearest + 1).astype(np.uint8)
        steps[:, at] = nearest
    return steps


STEPS = _walk_table()
ROWS = [row.tobytes() for row in STEPS]
FLAT = STEPS.ravel().astype(np.int64)


def _samples() -> list[np.ndarray]:
    rng = np.random.default_rng(SEED + 1)
    out = []
    for o in range(OCTAVES):
        size = 1 << o
        inside = np.arange(size) if size <= PER_OCTAVE else np.unique(rng.integers(0, size, 4 * PER_OCTAVE))
        if size > PER_OCTAVE:
            inside = np.sort(rng.permutation(inside)[:PER_OCTAVE])
        out.append(size - 1 + inside)
    return out


SAMPLES = _samples()  # output positions from 0 on
WEIGHT = np.concatenate([np.full(len(s), (1 << o) / len(s)) for o, s in enumerate(SAMPLES)])


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def classes(chars: np.ndarray) -> np.ndarray:
    return (mixed(chars.astype(np.uint64)) & np.uint64(CLASSES - 1)).astype(np.int64)


def walk(codes: list[np.ndarray], starts: list[int]) -> list[np.ndarray]:
    """For each text, the output position after every character."""
    order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
    lengths = np.array([len(codes[i]) for i in order])
    together = int(lengths[FEW - 1]) if len(order) >= FEW else 0
    grid = np.zeros((together, len(order)), np.int64)
    for lane, i in enumerate(order):
        part = codes[i][:together]
        grid[: len(part), lane] = part * PERIOD
    at = np.array([starts[i] for i in order], np.int64)
    ends = np.zeros((together, len(order)), np.int64)
    active = len(order) - np.searchsorted(lengths[::-1], np.arange(together), side="right")
    for k in range(together):
        n = active[k]
        lane = at[:n]
        lane += FLAT[grid[k, :n] + (lane & PERIOD - 1)]
        ends[k, :n] = lane
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(codes)
    for lane, i in enumerate(order):
        n = min(len(codes[i]), together)
        done, place = ends[:n, lane], int(at[lane])
        if len(codes[i]) > together:
            alone = []
            for c in codes[i][together:].tolist():
                place += ROWS[c][place & PERIOD - 1]
                alone.append(place)
            done = np.concatenate([done, np.array(alone, np.int64)])
        out[i] = done
    return out


def sample(chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digits of the sampled characters, octave by octave as far as the output goes."""
    if not len(ends):
        return np.zeros(0, np.uint8)
    total = int(ends[-1])
    wanted = np.concatenate(SAMPLES[: total.bit_length()])
    at = np.searchsorted(ends, wanted, side="right")
    digits = (mixed(chars[np.minimum(at, len(chars) - 1)].astype(np.uint64), 1) & np.uint64(15)).astype(np.uint8)
    digits[at == len(ends)] = PAD
    return digits


def written(digits: np.ndarray) -> str:
    return "".join("0123456789abcdef."[min(d, 16)] for d in digits.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of output positions with equal digits, of those either has."""
    n = max(len(a), len(b))
    if not n:
        return 1.0
    a, b = (np.append(x, np.full(n - len(x), PAD, np.uint8)) for x in (a, b))
    either = (a != PAD) | (b != PAD)
    weight = WEIGHT[:n]
    return float(weight[(a == b) & either].sum() / weight[either].sum())


def fingerprints(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(characters, ends of the walk, digits) of each text."""
    chars = [characters(t) for t in texts]
    ends = walk([classes(c) for c in chars], [0] * len(chars))
    return [(c, e, sample(c, e)) for c, e in zip(chars, ends)]


def edited(made: list[tuple], following: list[tuple]) -> list[tuple[bytes, np.ndarray]]:
    """(UTF-8, digits) of each text with its last third replaced from the following text;
    the walk goes on from where the kept part ends."""
    keep = [len(c) - len(c) // 3 for c, _, _ in made]
    tails = [f[0][: len(m[0]) // 3] for m, f in zip(made, following)]
    starts = [int(e[k - 1]) if k else 0 for (_, e, _), k in zip(made, keep)]
    ends = walk([classes(t) for t in tails], starts)
    out = []
    for (c, e, _), k, tail, more in zip(made, keep, tails, ends):
        chars = np.concatenate([c[:k], tail])
        text = chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        out.append((text, sample(chars, np.concatenate([e[:k], more]))))
    return out


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds that are not above the key, by binary search."""
    depth = max(1, len(bounds).bit_length())
    padded = F.lit(bounds + [(1 << 63) - 1] * ((1 << depth) - len(bounds)))
    halves = F.array(*[F.lit(1 << d) for d in reversed(range(depth))])
    return F.aggregate(
        halves, F.lit(0), lambda at, half: at + F.when(F.element_at(padded, at + half) <= key, half).otherwise(0)
    )


def in_ranges(docs: DataFrame) -> DataFrame:
    """range, key, copied, doc_id, text: every range with the first document of the next."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("key"), "doc_id", "text")
    ids = rows.select(F.col("key").alias("id"))
    cuts = ids.approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts)
    rows = rows.withColumn("range", range_of(F.col("key"), sorted({int(c) for c in cuts})))
    heads = sorted(tuple(r) for r in rows.groupBy("range").agg(F.max("key")).collect())  # a row per range
    before = [(head, heads[(i + 1) % len(heads)][0]) for i, (_, head) in enumerate(heads)]
    also = spark.createDataFrame(before, "head long, also int")
    placed = rows.join(F.broadcast(also), rows["key"] == also["head"], "left")
    own = F.struct(F.col("range"), F.lit(False).alias("copied"))
    copy = F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("range"), F.lit(True).alias("copied")))
    spread = placed.select(F.explode(F.array_compact(F.array(own, copy))).alias("to"), "key", "doc_id", "text")
    order = [F.col("range"), F.col("copied"), F.col("key").desc(), F.xxhash64("text")]
    return spread.select("to.*", "key", "doc_id", "text").repartition(parts, "range").sortWithinPartitions(*order)


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the next smaller doc_id, and the largest after the smallest; a
    null doc_id counts as smallest. Rows with one doc_id follow each other in the order of
    a hash of their texts. Null texts count as empty; an empty text has the fingerprint
    ''. A single document is its own next. Ids are whole numbers. Extra columns are
    ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # at most one row: the last, whose next has not come yet
        rows = chain.from_iterable(zip(*(b.column(c).to_pylist() for c in ("range", "copied", "doc_id", "text"))) for b in batches)
        for part in batched(rows, LANES):
            made = held + list(zip(part, fingerprints([t or "" for *_, t in part])))
            pairs = [(a, b) for a, b in zip(made, made[1:]) if a[0][0] == b[0][0] and not a[0][1]]
            held = made[-1:]
            if pairs:
                yield answer(pairs)

    def answer(pairs: list[tuple]) -> pa.RecordBatch:
        changed = edited([a[1] for a, _ in pairs], [b[1] for _, b in pairs])
        digits = [a[1][2] for a, _ in pairs]
        columns = [
            pa.array([a[0][2] for a, _ in pairs], kind),
            pa.array([len(a[1][0]) for a, _ in pairs], pa.int64()),
            pa.array([sha256(text).hexdigest() for text, _ in changed]),
            pa.array([written(d) for d in digits]),
            pa.array([written(d) for _, d in changed]),
            pa.array([likeness(d, e) for d, (_, e) in zip(digits, changed)], pa.float64()),
            pa.array([likeness(d, b[1][2]) for d, (_, b) in zip(digits, pairs)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    small_batches(docs.sparkSession)
    fields = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    schema = keyed(docs, fields)
    kind = {"int": pa.int32(), "bigint": pa.int64()}[schema["doc_id"].dataType.simpleString()]
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    return in_ranges(docs).mapInArrow(run, schema)


def _levels() -> list[int]:
    """Prefixes of the fingerprint that bands are drawn from: quarters of its octaves."""
    ends = np.cumsum([0, *map(len, SAMPLES)])
    inside = {int(first + q * n // 4) for first, n in zip(ends, map(len, SAMPLES)) for q in range(4)}
    return sorted(inside - {0})


LEVELS = _levels()
REACH = np.concatenate([[0.0], np.cumsum(WEIGHT)])  # weight of the first digits
VALUE = np.full(256, PAD, np.uint8)
VALUE[np.frombuffer(b"0123456789abcdef", np.uint8)] = np.arange(16)


@cache
def picks(level: int, bands: int, digits: int) -> np.ndarray:
    """For each band of a level the digits it takes: a digit's chance follows its weight, as
    in likeness. Of a short prefix a band takes half the digits."""
    rng = np.random.default_rng([SEED + 2, level])
    weight = WEIGHT[:level] / REACH[level]
    return np.array([rng.choice(level, max(1, min(digits, level // 2)), replace=False, p=weight) for _ in range(bands)])


def digit_rows(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digits of fingerprints as rows filled up with PAD, and how many digits each has."""
    rows = np.full((len(prints), max(map(len, prints), default=0)), PAD, np.uint8)
    for row, p in zip(rows, prints):
        row[: len(p)] = VALUE[np.frombuffer(p.encode(), np.uint8)]
    return rows, (rows != PAD).sum(axis=1)


def band_keys(prints: list[str], bands: int, digits: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of the fingerprint, key) of every band. A fingerprint has bands on each level
    that one alike and not longer may have as its longest, so two that are alike have the
    longest level of the shorter one in common."""
    rows, n = digit_rows(prints)
    owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for level, beyond in zip(LEVELS, [*LEVELS[1:], len(WEIGHT) + 1]):
        at = np.flatnonzero((n >= level) & (REACH[beyond - 1] >= least * REACH[n]))
        if not len(at):
            continue
        taken = rows[at][:, picks(level, bands, digits)].astype(np.uint64)  # fingerprint, band, digit
        packed = np.zeros(taken.shape[:2], np.uint64)
        for k in range(taken.shape[2]):
            packed = mixed(packed + taken[:, :, k], k)
        tags = mixed(np.arange(bands, dtype=np.uint64) + np.uint64(level * bands), 2)
        owners.append(np.repeat(at, bands))
        keys.append(mixed(packed ^ tags).ravel())
    return np.concatenate(owners), np.concatenate(keys)


def alike_rows(one: np.ndarray, n: int, others: np.ndarray, lengths: np.ndarray, least: float) -> np.ndarray:
    """Whether a row of digits and each of others, all filled up with PAD, are alike."""
    longer = REACH[np.maximum(lengths, n)]
    same = (others == one) & (others != PAD)
    return (same @ WEIGHT[: len(one)] >= least * longer) | (longer == 0)


def digest(fingerprint: str) -> Column:
    return F.md5(F.col(fingerprint))


def banded_heads(spark: SparkSession, heads: DataFrame, bands: int, digits: int, least: float) -> DataFrame:
    """doc, fingerprint, reach (weight of its digits) and shingles (keys of its bands that
    more than one document has) of the documents with any: what follows moves no others.
    A sketch of all keys leaves out most that one document alone has, and a second one of
    those that pass, by another hash, nearly all the others."""
    width = sketch.width_for(heads.count() * bands * 3, most=MOST_CELLS)
    narrow = max(sketch.BLOCK, width >> 2)
    prints, context = heads.select("fingerprint"), spark.sparkContext

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            yield band_keys(batch.column(0).to_pylist(), bands, digits, least)[1]

    bits = context.broadcast(sketch.repeated(prints, every, width, 1))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for keys in every(batches):
            yield mixed(keys[sketch.estimated_twice(bits.value, width, keys)], 3)

    again = context.broadcast(sketch.repeated(prints, passing, narrow, 1))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fingerprint").to_pylist()
            owners, keys = band_keys(prints, bands, digits, least)
            reach = REACH[digit_rows(prints)[1]]
            often = sketch.estimated_twice(bits.value, width, keys)
            often &= sketch.estimated_twice(again.value, narrow, mixed(keys, 3))
            owners, keys = owners[often], keys[often].view(np.int64)
            order = np.argsort(owners, kind="stable")
            some, starts = np.unique(owners[order], return_index=True)
            shingles = pa.ListArray.from_arrays(pa.array([*starts, len(owners)], pa.int32()), pa.array(keys[order], pa.int64()))
            columns = [batch.column(c).take(pa.array(some, pa.int64())) for c in ("doc", "fingerprint")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(reach[some]), shingles], ["doc", "fingerprint", "reach", "shingles"])

    fields = "doc long, fingerprint string, reach double, shingles array<long>"
    return stored(spark, heads.select("doc", "fingerprint").mapInArrow(spread, fields), "bands")


def band_lists(spark: SparkSession, heads: DataFrame, bands: int, digits: int, least: float) -> DataFrame:
    """shingle (a band's key), doc, n, component, reach, of bands that more than one document has."""
    return lists_of(banded_heads(spark, heads, bands, digits, least))


def lists_of(banded: DataFrame) -> DataFrame:
    return banded.select(F.explode("shingles").alias("shingle"), "doc", F.lit(0).alias("n"), F.col("doc").alias("component"), "reach")


def led_lists(lists: DataFrame) -> DataFrame:
    """The lists of more than one document, each row with its list's leader, the smallest
    document, and most, the greatest reach there."""
    leaders = lists.groupBy("shingle").agg(F.min("doc").alias("leader"), F.max("doc").alias("last"), F.max("reach").alias("most"))
    return lists.join(leaders.where("leader < last").drop("last"), "shingle")


def leader_distances(led: DataFrame, heads: DataFrame, least: float) -> DataFrame:
    """doc, leader, far (weight of the digits in which they differ), alike: every document
    with the leaders of its lists, at most a pair for a row of the lists."""
    pairs = led.where("doc > leader").select("doc", "leader").distinct()
    named = heads.select(F.col("doc").alias("leader"), F.col("fingerprint").alias("lead_print"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("fingerprint").to_pylist(), batch.column("lead_print").to_pylist())
            made = [digit_rows(list(pair)) for pair in pairs]
            alike = [bool(alike_rows(rows[0], n[0], rows[1:], n[1:], least)[0]) for rows, n in made]
            far = [float(WEIGHT[: rows.shape[1]] @ (rows[0] != rows[1])) for rows, _ in made]
            columns = [batch.column("doc"), batch.column("leader"), pa.array(far, pa.float64()), pa.array(alike, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "leader", "far", "alike"])

    both = pairs.join(heads.select("doc", "fingerprint"), "doc").join(named, "leader")
    fields = "doc long, leader long, far double, alike boolean"
    return both.select("doc", "leader", "fingerprint", "lead_print").mapInArrow(verify, fields)


def leader_links(lists: DataFrame, heads: DataFrame, least: float) -> DataFrame:
    """Links (left, right) of every document with the leaders of its bands: at most a pair
    for a row of the lists. A band's leader is its smallest document."""
    led = led_lists(lists.withColumn("reach", F.lit(0.0)))  # which only near_lists needs
    return alike_pairs(leader_distances(led, heads, least))


def alike_pairs(distances: DataFrame) -> DataFrame:
    return distances.where("alike").select(F.col("doc").alias("left"), F.col("leader").alias("right"))


def near_lists(led: DataFrame, distances: DataFrame, grouped: DataFrame, least: float) -> DataFrame:
    """shingle, doc, n, component: the led lists, cut into those that may still have a link
    between components.

    The weight of the digits in which two fingerprints differ, a missing one being a digit of
    its own, is a distance, and alike ones are at most (1 - least) * most apart. So by the
    triangle inequality the distances of two alike ones from their leader differ by no more.
    A list's rows are counted in rings around its leader, FINE of them in that difference. A
    ring stays if rings of another component are within reach of it, and where the next one
    that stays is out of reach a new list begins. No alike pair of two components is parted.
    """
    named = grouped.select(F.col("node").alias("doc"), F.col("component").alias("now"))
    span = F.col("most") * (1 - least) * (1 + 1e-6)  # for rounding
    rows = (
        led.join(named, "doc", "left")
        .join(distances.select("doc", "leader", "far"), ["doc", "leader"], "left")
        .select(
            "shingle", "doc", "n", F.coalesce("now", "component").alias("component"),
            F.floor(F.coalesce("far", F.lit(0.0)) / span * FINE).alias("ring"),  # of the leader 0
        )
    )
    rings = rows.groupBy("shingle", "ring").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    order = Window.partitionBy("shingle").orderBy("ring")  # of at most FINE / (1 - least) + 1 rows
    reach = order.rangeBetween(-FINE, FINE)
    kept = rings.select("shingle", "ring", F.min("first").over(reach).alias("low"), F.max("last").over(reach).alias("high")).where("low < high")
    begins = F.col("ring") - F.lag("ring").over(order) > FINE
    parts = kept.withColumn("begins", begins.cast("int")).select(
        "shingle", "ring", F.coalesce(F.sum("begins").over(order), F.lit(0)).alias("part")
    )
    return rows.join(parts, ["shingle", "ring"]).select(F.xxhash64("shingle", "part").alias("shingle"), "doc", "n", "component")


def tile_links(tiled: DataFrame, heads: DataFrame, least: float) -> DataFrame:
    """Links (left, right) that join components, tile by tile: every document of one bucket
    is compared with those of the other that are not in its component by then."""

    def search(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by("doc")
        ids, component, bucket, prints = (tile.column(c).to_pylist() for c in ("doc", "component", "bucket", "fingerprint"))
        rows, n = digit_rows(prints)
        name = np.unique(np.array(component), return_inverse=True)[1]
        bucket = np.array(bucket)
        right = np.flatnonzero(bucket == tile.column("high")[0].as_py())
        found = []
        for i in np.flatnonzero(bucket == tile.column("low")[0].as_py()).tolist():
            near = (np.minimum(REACH[n[right]], REACH[n[i]]) >= least * np.maximum(REACH[n[right]], REACH[n[i]])) & (name[right] != name[i])
            others = right[near]
            for k in others[alike_rows(rows[i], int(n[i]), rows[others], n[others], least)].tolist():
                if name[k] != name[i]:
                    found.append((ids[i], ids[k]))
                    name[name == name[k]] = name[i]
        return pa.table({"left": pa.array([a for a, _ in found], pa.int64()), "right": pa.array([b for _, b in found], pa.int64())})

    placed = tiled.join(heads.select("doc", "fingerprint"), "doc")
    return placed.groupBy("low", "high").applyInArrow(search, "left long, right long")


LEAST = 0.8  # likeness of near copies
FOUND = 0.99  # share of the pairs of just that likeness that meet in a band
CHANCE = 0.17  # share of digits in which unlike texts agree, as bands of 6 to 9 digits show it
# Unlike fingerprints that one meets by chance. From about one on, the chance meetings alone connect
# most fingerprints to one family of tiles, which takes more rounds the larger the table is.
MET = 0.25
FINE = 8  # rings around a leader within the distance of alike ones


def band_plan(n: int, least: float = LEAST) -> tuple[int, int]:
    """Bands and their digits for n fingerprints: so many digits that each fingerprint meets
    few unlike ones by chance (MET), whatever n is, and then so many bands that alike ones
    still meet."""
    digits = 6
    while True:
        bands = ceil(log(1 - FOUND) / log(1 - least**digits))
        if n * bands * CHANCE**digits <= MET:
            return bands, digits
        digits += 1


def near_classes(spark: SparkSession, prints: DataFrame, bands: int | None, digits: int | None, least: float) -> DataFrame:
    """doc (digest of a fingerprint), near_class and near_class_size of the fingerprints of
    classes of more than one document.

    Equal fingerprints are one document here. First each is compared with the leaders of its
    bands, which joins nearly all near copies in a number of pairs that is linear in their bands; then all that
    share a band, are still in different components and are not kept apart by their distances
    from the band's leader, in tiles of two buckets. So every pair with a band in common is
    verified, already in one class or known not to be alike.
    """
    some = prints.where("doc_id is not null and fingerprint is not null")
    heads = some.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("size"))
    # Numbers hold once they are written, and are shorter than digests in every later shuffle.
    heads = stored(spark, heads.withColumn("doc", F.monotonically_increasing_id()), "print-heads")
    if not bands or not digits:
        bands, digits = band_plan(heads.count(), least)
    banded = banded_heads(spark, heads, bands, digits, least)
    led = stored(spark, led_lists(lists_of(banded)), "led-lists")
    distances = stored(spark, leader_distances(led, banded, least), "leader-distances")
    grouped = components(spark, alike_pairs(distances))
    lists = stored(spark, near_lists(led, distances, grouped, least), "near-lists")
    tiled = stored(spark, tiles(spark, lists), "tiles")
    joined = grouped.select(F.col("component").alias("left"), F.col("node").alias("right"))
    grouped = components(spark, joined.unionByName(stored(spark, tile_links(tiled, banded, least), "tile-links")))
    short = heads.select("doc", digest("fingerprint").alias("digest"), "first_id", "size")
    named = short.join(grouped.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("digest").alias("doc"), "first_id", "size", F.coalesce("component", "doc").alias("component")
    )
    classes = named.groupBy("component").agg(F.min("first_id").alias("near_class"), F.sum("size").alias("near_class_size"))
    return stored(spark, named.join(classes.where("near_class_size > 1"), "component").select("doc", "near_class", "near_class_size"), "near-classes")


def near_duplicates(spark: SparkSession, prints: DataFrame, bands: int | None = None, digits: int | None = None, least: float = LEAST) -> DataFrame:
    """doc_id and leader, the smallest doc_id of its class: documents whose fingerprints
    (doc_id, fingerprint) are alike, but for the leaders.

    Bands are samples of digits over the whole of the shorter output (as many as band_plan
    says, unless given), weighed as in likeness: most lie in its last octaves, and no part of the text is without. The likeness
    of the whole fingerprints verifies every pair with a band in common that verified pairs
    do not already connect. Short texts have short bands, and equal fingerprints are always
    alike, so empty texts are one class. Rows with a null doc_id are alike with nothing.
    """
    found = near_classes(spark, prints, bands, digits, least)
    return (
        prints.where("doc_id is not null")
        .select("doc_id", digest("fingerprint").alias("doc"))
        .join(found, "doc")
        .where("doc_id > near_class")
        .select("doc_id", F.col("near_class").alias("leader"))
        .distinct()
    )


def with_classes(spark: SparkSession, prints: DataFrame, bands: int | None = None, digits: int | None = None, least: float = LEAST) -> DataFrame:
    """prints (doc_id, fingerprint and others; written, as it is read several times) with
    near_class, the smallest doc_id of the rows that verified pairs connect with the row, and
    near_class_size, their number. Both are null without a doc_id."""
    found = near_classes(spark, prints, bands, digits, least)
    width = sketch.width_for(found.count(), most=MOST_CELLS)
    half = lambda doc: np.array([int(d[:16], 16) for d in doc.to_pylist()], np.uint64)
    every = lambda batches: (half(batch.column(0)).repeat(2) for batch in batches)
    bits = spark.sparkContext.broadcast(sketch.repeated(found.select("doc"), every, width, 1))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = sketch.estimated_twice(bits.value, width, half(batch.column("doc")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(met)], [*batch.schema.names, "met"])

    # A sketch of the classes' documents keeps the rows of the others out of the join's shuffle.
    named = prints.withColumn("doc", F.coalesce(digest("fingerprint"), F.lit("0" * 32)))
    rows = named.mapInArrow(marked, StructType([*named.schema, StructField("met", BooleanType())]))
    may = F.col("met") & F.col("doc_id").isNotNull()
    own = F.when(F.col("doc_id").isNotNull(), F.lit(1)).cast("long")
    alone = rows.where(~may).select(*prints.columns, F.col("doc_id").alias("near_class"), own.alias("near_class_size"))
    others = rows.where(may).join(found, "doc", "left")
    return others.select(
        *prints.columns, F.coalesce("near_class", "doc_id").alias("near_class"), F.coalesce("near_class_size", own).alias("near_class_size")
    ).unionByName(alone)


def op8_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = edit_fingerprints(table(spark, sf_dir, "documents"))
    return with_classes(spark, stored(spark, prints, "fingerprints"))

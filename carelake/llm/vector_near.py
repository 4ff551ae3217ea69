"""Near-duplicate vectors by cosine: int8 tile products with rigorous error bounds.

1. Equal vectors are one class; a very common vector is one row from then on.
2. A vector of length 1 is stored as int8 codes, a scale and the exact length eps of what
   the codes miss. For two of them, |cosine - product of codes| <= eps1 + (1 + eps1) eps2.
3. Classes are dealt into tiles of bounded size, near ones together: by the nearest of at
   most PIVOTS pivots, each of which has as many tiles as its count needs. A class is sent to the tiles of a
   pivot only if it can have a link there: its angle to the pivot is within the pivot's
   radius plus the angle of the threshold.
4. Each pair of tiles is one product of codes. Pairs whose bound stays below the threshold
   end here; pairs surely above it are links. Rows of undecided pairs alone are sent once
   more, with the vector in double precision, and decided.
5. A pair of tiles returns, for each row, how many vectors it links to, and the links of a
   spanning forest. Links themselves are never rows, so a large group stays linear per tile.

Work: the product of all pairs that the pivots cannot tell apart. Where vectors are spread
evenly this is every pair, at a byte a dimension; where they have clusters, it is the pairs
within neighbouring clusters.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import stored, table
from carelake.llm.components import components
from carelake.llm.wordhash import mixed

THRESHOLD = 0.9
PIVOTS, SAMPLE, ROUNDS = 64, 4096, 5
TILE, MOST_TILE, TILES = 4096, 32768, 64  # rows of a tile: the table's share, within two bounds
STRIP = 1 << 21  # products held at a time
ANGLE_SLACK = 1e-6


def unit_vectors(column: pa.Array) -> np.ndarray:
    """Rows of length 1; a shorter vector is filled up with zeros.

    Each is first scaled by a power of two, which is exact, so no square over- or underflows."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    _, power = np.frexp(np.abs(out).max(axis=1, initial=0.0))
    out = np.ldexp(out, -power[:, None])
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and an upper bound of the length that codes times scale miss."""
    scale = np.abs(units).max(axis=1, initial=0.0) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    missed = units - codes * scale[:, None]
    return codes, scale, np.sqrt((missed * missed).sum(axis=1)) + 1e-12


class Side:
    """Rows of one tile, ready for products."""

    def __init__(self, codes: list[bytes], scale: np.ndarray, eps: np.ndarray):
        width = max(map(len, codes), default=0)
        flat = b"".join(c.ljust(width, b"\0") for c in codes)
        whole = np.frombuffer(flat, np.int8).reshape(len(codes), width)
        self.values = (whole * scale[:, None]).astype(np.float32)
        self.eps = eps


def close_pairs(left: Side, right: Side, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, surely): pairs whose bound reaches the threshold, each once if left is right."""
    width = min(left.values.shape[1], right.values.shape[1])
    slack = (width + 8) * 2.0**-22  # single-precision rounding of the product and its sum
    grown = right.eps * (1 + left.eps.max(initial=0.0))
    # The two further columns add the error bound to the product.
    a = np.column_stack([left.values[:, :width], left.eps, np.ones(len(left.eps))]).astype(np.float32)
    b = np.column_stack([right.values[:, :width], np.ones(len(grown)), grown]).astype(np.float32)
    step = max(1, STRIP // max(1, len(b)))
    for first in range(0, len(a), step):
        bound = a[first : first + step] @ b.T
        i, j = np.nonzero(bound >= np.float32(threshold - slack))
        most = bound[i, j].astype(np.float64)
        i += first
        if same:
            i, j, most = (x[i < j] for x in (i, j, most))
        yield i, j, most - 2 * (left.eps[i] + grown[j]) - slack >= threshold


class Forest:
    """Counts and spanning links of the rows of one pair of tiles."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.links, self.label = copies, np.zeros(len(copies), np.int64), np.arange(len(copies))
        self.edges: list[tuple[int, int]] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links of distinct pairs, ordered by i."""
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        rows, starts = np.unique(i, return_index=True)
        for row, others in zip(rows.tolist(), np.split(j, starts[1:])):
            labels, at = np.unique(self.label[others], return_index=True)
            new = labels != self.label[row]
            if new.any():
                self.edges += [(row, int(others[k])) for k in at[new]]
                labels = np.append(labels, self.label[row])
                self.label[np.isin(self.label, labels)] = labels.min()


FOUND = "cls long, links long, other long, asks long, tile long"


def _found(rows: pa.Table, forest: Forest, pair: int, asking: np.ndarray) -> pa.Table:
    """One row per class with links, per spanning link, and per class with an open pair."""
    cls, tile = _numbers(rows, "cls"), _numbers(rows, "tile")
    counted = np.flatnonzero(forest.links)
    edges = np.array(forest.edges, np.int64).reshape(-1, 2)
    n, m, k = len(counted), len(edges), len(asking)
    void = [None]
    return pa.table(
        {
            "cls": pa.array(np.concatenate([cls[counted], cls[edges[:, 0]], cls[asking]]), pa.int64()),
            "links": pa.array(np.concatenate([forest.links[counted], np.zeros(m + k, np.int64)]), pa.int64()),
            "other": pa.array(void * n + cls[edges[:, 1]].tolist() + void * k, pa.int64()),
            "asks": pa.array(void * (n + m) + [pair] * k, pa.int64()),
            "tile": pa.array(void * (n + m) + tile[asking].tolist(), pa.int64()),
        }
    )


def _halves(tile: np.ndarray, pair: int, tiles: int) -> tuple[np.ndarray, np.ndarray, bool]:
    low, high = divmod(pair, tiles)
    return np.flatnonzero(tile == low), np.flatnonzero(tile == high), low == high


def _numbers(found: pa.Table, name: str) -> np.ndarray:
    return found.column(name).to_numpy()


class Pivots:
    """Directions that near classes share, with radius and tiles of each."""

    def __init__(self, units: np.ndarray, n: int):
        centres = units[np.linspace(0, len(units) - 1, n).astype(int)] if len(units) else np.zeros((1, 0))
        for _ in range(ROUNDS if n > 1 else 0):
            nearest = (units @ centres.T).argmax(axis=1)
            sums = np.array([units[nearest == k].sum(axis=0) for k in range(n)])
            length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
        self.centres = centres

    def angles(self, units: np.ndarray) -> np.ndarray:
        width = min(units.shape[1], self.centres.shape[1])
        return np.arccos(np.clip(units[:, :width] @ self.centres[:, :width].T, -1, 1))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: vector, first (smallest id), copies."""
    value = F.col("vector")
    usable = (
        F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(value, lambda x: x != 0)
    )
    return vectors.where(usable).groupBy("vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))


def near_links(spark: SparkSession, classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """cls, links and other: for classes (cls, vector, copies), rows with a number of
    vectors linked to (to be summed by cls) and rows with a link of a spanning forest."""
    n = classes.count()
    size = min(MOST_TILE, max(TILE, ceil(n / TILES)))
    picked = classes.orderBy(F.xxhash64("cls"), "cls").select("vector").limit(SAMPLE if n > size else 1).toArrow()
    pivots = Pivots(unit_vectors(picked.column(0).combine_chunks()), min(PIVOTS, max(1, ceil(n / size))))
    reach = acos(threshold) + ANGLE_SLACK

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = pivots.angles(unit_vectors(batch.column(0)))
            nearest = angles.argmin(axis=1)
            for k in np.unique(nearest).tolist():
                own = angles[nearest == k, k]
                yield pa.RecordBatch.from_pydict({"pivot": [k], "rows": [len(own)], "radius": [float(own.max())]})

    sums = classes.select("vector").mapInArrow(measure, "pivot long, rows long, radius double").groupBy("pivot")
    known = {r.pivot: r for r in sums.agg(F.sum("rows").alias("n"), F.max("radius").alias("radius")).collect()}
    counts = [ceil(known[k].n / size) if k in known else 1 for k in range(len(pivots.centres))]
    radius = np.array([known[k].radius if k in known else 0.0 for k in range(len(counts))])
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    tiles = int(starts[-1])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cls = batch.column(0).to_numpy()
            units = unit_vectors(batch.column(1))
            codes, scale, eps = quantised(units)
            angles = pivots.angles(units)
            nearest = angles.argmin(axis=1)
            share = (mixed(cls.astype(np.uint64)) % np.array(counts, np.uint64)[nearest]).astype(np.int64)
            own = starts[nearest] + share
            rows = pa.RecordBatch.from_pydict(
                {
                    "cls": batch.column(0),
                    "copies": batch.column(2),
                    "tile": pa.array(own),
                    "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "scale": pa.array(scale),
                    "eps": pa.array(eps),
                }
            )
            for k in range(len(counts)):
                sent = np.flatnonzero(angles[:, k] <= radius[k] + reach)
                part = rows.take(pa.array(sent))
                for other in range(starts[k], starts[k + 1]) if len(sent) else ():
                    pair = np.minimum(own[sent], other) * tiles + np.maximum(own[sent], other)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pair)], [*part.schema.names, "pair"])

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        pair = key[0].as_py()
        lows, highs, same = _halves(_numbers(rows, "tile"), pair, tiles)
        codes, scale, eps = rows.column("codes").to_pylist(), _numbers(rows, "scale"), _numbers(rows, "eps")
        left, right = (Side([codes[i] for i in half], scale[half], eps[half]) for half in (lows, highs))
        forest, open_rows = Forest(_numbers(rows, "copies")), np.zeros(len(codes), bool)
        for i, j, surely in close_pairs(left, right, threshold, same):
            i, j = lows[i], highs[j]
            forest.add(i[surely], j[surely])
            open_rows[i[~surely]] = open_rows[j[~surely]] = True
        return _found(rows, forest, pair, np.flatnonzero(open_rows))

    dealt = classes.select("cls", "vector", "copies").mapInArrow(
        deal, "cls long, copies long, tile long, codes binary, scale double, eps double, pair long"
    )
    first = stored(spark, dealt.groupBy("pair").applyInArrow(compare, FOUND), "vector-links")

    def decide(key: tuple, rows: pa.Table) -> pa.Table:
        """The undecided pairs again, in double precision."""
        units = unit_vectors(rows.column("vector").combine_chunks())
        lows, highs, same = _halves(_numbers(rows, "tile"), key[0].as_py(), tiles)
        codes, scale, eps = quantised(units)
        left, right = (Side([codes[i].tobytes() for i in half], scale[half], eps[half]) for half in (lows, highs))
        forest = Forest(_numbers(rows, "copies"))
        for i, j, surely in close_pairs(left, right, threshold, same):
            i, j = lows[i[~surely]], highs[j[~surely]]
            step = max(1, STRIP // max(1, units.shape[1]))
            cosine = [np.einsum("ij,ij->i", units[i[k : k + step]], units[j[k : k + step]]) for k in range(0, len(i), step)]
            near = np.concatenate([*cosine, np.zeros(0)]) >= threshold
            forest.add(i[near], j[near])
        return _found(rows, forest, 0, np.zeros(0, np.int64))

    asked = first.where("asks is not null").select("cls", "tile", F.col("asks").alias("pair"))
    again = asked.join(classes.select("cls", "vector", "copies"), "cls").groupBy("pair").applyInArrow(decide, FOUND)
    return first.where("asks is null").unionByName(again).select("cls", "links", "other")


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of vectors (vec_id, embedding; others are left out): vec_id, n_links,
    component_id and kept.

    Two rows link if their cosine, in double precision, is at least the threshold (above 0).
    n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable by links, the row's own included, and kept marks the row that has it. Null,
    empty and zero vectors, and those with a null or non-finite component, link with
    nothing. A shorter vector counts as filled up with zeros. A row without vec_id takes
    part in links; alone, its component_id is null and it is kept. Rows that share a vec_id
    are separate rows, each with the links of its own vector."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    numbered = vector_classes(rows).select(F.monotonically_increasing_id().alias("cls"), "vector", "first", "copies")
    classes = stored(spark, numbered, "vector-classes")
    found = stored(spark, near_links(spark, classes, threshold), "vector-found")
    tied = components(spark, found.where("other is not null").select(F.col("cls").alias("left"), F.col("other").alias("right")))
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    known = (
        classes.join(linked, "cls", "left")
        .join(tied.withColumnRenamed("node", "cls"), "cls", "left")
        .select("vector", "first", F.coalesce("component", "cls").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    least = known.groupBy("component").agg(F.min("first").alias("least"))
    result = known.join(least, "component").select("vector", "n_links", "least")
    joined = rows.join(result, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"),
    )
    return joined.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_vector_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector of embeddings."""
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


ORACLE = f"""
with recursive usable as (
  select vec_id, embedding::double[] as v from embeddings
  where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as l, b.vec_id as r from usable a join usable b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reach as (
  select l, r from links union select reach.l, links.r from reach join links on reach.r = links.l),
smallest as (select l, min(r) as m from reach group by l),
counts as (select l, count(*) as n from links group by l)
select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(m, vec_id)) as component_id,
       vec_id <= coalesce(m, vec_id) as kept
from embeddings left join smallest on vec_id = smallest.l left join counts on vec_id = counts.l
"""

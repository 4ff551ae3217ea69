"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text without its blanks is cut where its own characters say so, which puts the same
cuts into the same passages wherever they stand. Chunks are deduplicated to verified
identifiers: the catalogue is grouped by the chunk's characters, map-side first, so a
chunk that a third of the corpus shares leaves each task once; two different chunks with
one hash get different ranks. A document becomes its ordered list of identifiers, and
documents are compared by these short lists. The texts themselves move once, as distinct
chunks, and are never compared or shuffled whole.

Equal lists mean equal texts and the reverse, since the cuts depend on the text alone and
an identifier stands for exactly one string of characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import stored, table, without_blanks

#: A cut follows at least MIN characters, before a vowel and one of five consonants
#: (about one place in twenty of Latin prose); text without such a place is cut at MAX.
MIN, MAX = 384, 2048
CUT = f"(?s)(?:.{{{MIN},{MAX}}}?(?=[aeiou][bdgmp])|.{{1,{MAX}}})"


def chunks(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit(CUT), F.lit(0))


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per chunk of every document (one without a chunk for an empty text)."""
    normal = docs.select(
        "doc_id",
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
        without_blanks(F.col("text")).alias("normal"),
    )
    return normal.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"),
        F.posexplode_outer(chunks(F.col("normal"))).alias("place", "chunk"),
    ).withColumn("hash", F.xxhash64("chunk"))


def catalogue(rows: DataFrame) -> DataFrame:
    """Distinct chunks by their characters: hash, chunk, n, and rank among those of one hash."""
    distinct = rows.where(F.col("chunk").isNotNull()).groupBy("hash", "chunk").agg(F.count("*").alias("n"))
    return distinct.withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))


def recipes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text_sha256, n_rows and recipe: the ordered list of verified identifiers.

    A row that repeats both id and text is one document, counted in n_rows.
    """
    rows = occurrences(docs)
    # Ranks above one exist only where 64-bit hashes collide; the planner sees how small
    # the written table is, and the chunks need no shuffle to meet it.
    again = stored(spark, catalogue(rows).where("rank > 1").select("hash", "chunk", "rank"), "chunk-ranks")
    named = rows.join(again, ["hash", "chunk"], "left")
    step = F.struct("place", F.struct("hash", F.coalesce("rank", F.lit(1)).alias("rank")).alias("id"))
    return (
        named.groupBy("doc_id", "n_chars", "text_sha256")
        .agg(
            F.collect_set(F.when(F.col("chunk").isNotNull(), step)).alias("steps"),
            F.count(F.when(F.coalesce("place", F.lit(0)) == 0, 1)).alias("n_rows"),
        )
        .select(
            "doc_id", "n_chars", "text_sha256", "n_rows", F.sort_array("steps")["id"].alias("recipe")
        )
    )


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    docs has doc_id and text; other columns are ignored, whatever their names. Texts are
    equal when identical without blanks; null counts as empty, so null, empty and blank
    texts are one group. The row with most code points stays, then the smallest doc_id
    (a null id last). Rows with one doc_id and different texts are separate documents;
    rows that repeat id and text give one row, and group_size counts them all. An empty
    table gives an empty result.
    """
    listed = recipes(spark, docs)
    first = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    groups = listed.groupBy("recipe").agg(F.min(first).alias("first"), F.sum("n_rows").alias("group_size"))
    kept = groups.select("recipe", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.shorter").alias("shorter"))
    return listed.join(kept, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == -F.col("shorter"))).alias("kept"),
        "text_sha256",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


ORACLE = r"""
with t as (
    select doc_id, coalesce(length(text), 0) as n_chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
    from documents
), g as (
    select *, first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id) as keep_id,
           count(*) over (partition by text_sha256) as group_size
    from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g
"""

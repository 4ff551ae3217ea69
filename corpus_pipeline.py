"""Corpus pipeline: the stages that turn raw documents into an encoded training mix.

Every stage but the last returns the columns of its documents. Decisions come back by id
in a semi join, so the documents' own columns, whatever their names, are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.byte_bpe import standard
from carelake.llm.common import stored, table
from carelake.llm.exact_dedup import exact_dedup
from carelake.llm.mixing import Mix
from carelake.llm.ngram_jaccard import ngram_jaccard
from carelake.llm.toxicity import score_toxicity


def _keeping(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with these ids (one row each); a null id matches a null id."""
    kept = ids.select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score does not reach the threshold."""
    return _keeping(docs, score_toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 0"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; a row given twice is one."""
    return _keeping(docs, exact_dedup(spark, docs).where("kept")).dropDuplicates(["doc_id", "text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near copies."""
    return _keeping(docs, ngram_jaccard(spark, docs).where("doc_id <=> component_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with the target weights."""
    return Mix().sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and ids of every document, and whether the ids
    decode to its text."""
    bpe = standard(spark)
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "source", "lang", "text")))
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "source", "lang", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing_weights", mix_sources),
    ("byte_bpe", encode),
]

#: None: a learned model, connected components and an encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's result written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

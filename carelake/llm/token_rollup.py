"""Token totals kept by signed changes in idempotent batches.

The store is a Parquet folder of additive sums per (source, lang, tokenizer): one
partition per committed batch, and a base that compaction folds batches into. A change
is signed: an insert adds a document's tokens, a delete takes them away, a revision adds
the difference. Totals are the base plus every later batch, so a batch costs its own
rows, never a recount, and a reader sums as many rows as there are groups and batches
since the base.

Committing a batch overwrites that batch's partition alone: a retry after a lost driver
or executor replaces what the first try left, and committing twice changes nothing. A
batch at or below the base is already folded in and is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import WORD, stored, table
from carelake.session import shared_path

KEYS = ("source", "lang", "tokenizer")
STORED = "source string, lang string, tokenizer string, n_docs long, n_tokens long, level string, batch long"
CHANGE = ("doc_id", *KEYS, "op", "n_tokens", "old_tokens")


def signed(changes: DataFrame) -> DataFrame:
    """Sums per group of one batch. Unknown or null ops and null counts add nothing.

    The same row twice in a batch is one change delivered twice, and counts once.
    """
    op = F.col("op")
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    tokens = F.when(op == "insert", new).when(op == "delete", -new).when(op == "revise", new - old).otherwise(0)
    docs = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0)
    return (
        changes.select(*CHANGE)
        .distinct()
        .groupBy(*KEYS)
        .agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))
    )


class Rollup:
    """changes: doc_id, source, lang, tokenizer, op (insert, delete, revise), n_tokens, old_tokens.

    Null keys are a group of their own. Other columns are ignored. Batches are numbered from 0.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def create(self) -> Rollup:
        """An empty base, so that a store without a commit has totals: none."""
        self._write(self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long"), "base", -1)
        return self

    def _write(self, sums: DataFrame, level: str, batch: int) -> None:
        sums.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/level={level}/batch={batch}")

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(self.path)

    def _base(self) -> int:
        """The newest base, from its rows; an empty base counts as none and hides nothing."""
        return self._rows().where("level = 'base'").agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]

    def commit(self, batch: int, changes: DataFrame) -> None:
        if batch > self._base():
            self._write(signed(changes), "delta", batch)

    def totals(self, through: int | None = None) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups that have come to nothing are left out."""
        base = self._base()
        rows = self._rows().where(
            ((F.col("level") == "base") & (F.col("batch") == base)) | ((F.col("level") == "delta") & (F.col("batch") > base))
        )
        if through is not None:
            rows = rows.where(F.col("batch") <= through)
        summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self, through: int) -> None:
        """Folds the batches up to a number into a base beside the old one; readers switch
        to it when it is complete, and a run cut short leaves the old base in force."""
        if through > self._base():
            self._write(self.totals(through), "base", through)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_and_marks(text: Column) -> Column:
    """Runs of letters and digits, and every other character but blanks, each one token."""
    pattern = r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def addresses(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]*@[^\x20\x09-\x0D]*")), F.lit(0)).cast("long")


def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all documents: every document is counted by words; labelled ones
    are recounted by another tokenizer version; unlabelled ones with mail addresses have
    their counts revised; toxic ones are withdrawn. The first batch is committed twice and
    the first two are folded into a base, which must not show."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    text = F.col("text")
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", words(text).alias("v1"), words_and_marks(text).alias("v2"), addresses(text).alias("mail")
    )
    joined = counted.join(labels.withColumn("labelled", F.lit(True)), "doc_id", "left")
    docs = stored(spark, joined, "token-counts")

    def change(rows: DataFrame, op: str, tokenizer: str, new: str, old: str = "0") -> DataFrame:
        return rows.selectExpr(
            "doc_id", "source", "lang", f"'{tokenizer}' as tokenizer", f"'{op}' as op",
            f"cast({new} as long) as n_tokens", f"cast({old} as long) as old_tokens",
        )

    labelled, rest = docs.where("labelled"), docs.where("labelled is null and mail > 0")
    rollup = Rollup(spark, shared_path(spark, "token-rollup")).create()
    inserted = change(docs, "insert", "words-1", "v1")
    rollup.commit(0, inserted)
    rollup.commit(0, inserted)
    rollup.commit(1, change(labelled, "delete", "words-1", "v1").union(change(labelled, "insert", "words-2", "v2")))
    rollup.compact(1)
    rollup.commit(2, change(rest, "revise", "words-1", "v1 - mail", "v1"))
    rollup.commit(3, change(labelled.where("toxic = 1"), "delete", "words-2", "v2"))
    return rollup.totals()


ORACLE = r"""
with l as (
    select doc_id, max(toxic) as toxic from labels group by doc_id
), d as (
    select source, lang, l.doc_id is not null as labelled, coalesce(toxic, 0) as toxic,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as v1,
           len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]')) as v2,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]*@[^\x20\x09-\x0D]*')) as mail
    from documents left join l on l.doc_id = documents.doc_id
)
select source, lang, case when labelled then 'words-2' else 'words-1' end as tokenizer,
       count(*) as n_docs, cast(sum(case when labelled then v2 else v1 - mail end) as bigint) as n_tokens
from d where not (labelled and toxic = 1)
group by all
"""

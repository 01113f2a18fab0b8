"""The corpus pipeline: quality, near-duplicates, repeated passages, benchmark passages, packing.

Every stage takes and returns rows of ``documents`` (the last one returns packed pieces), and works on all that
the stage before has kept. Texts that a stage has cut to nothing go. Rows that repeat an id are one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm.fmindex import remove_passages
from logtide.llm.hyperminhash import near_duplicates
from logtide.llm.linecrf import fit_quality, score_quality
from logtide.llm.packing import pack
from logtide.llm.queries import held_out, table
from logtide.llm.superkmers import remove_repeats
from logtide.llm.tokens import WHOLE, count_tokens
from logtide.llm.words import small_batches
from logtide.scratch import materialize

GOOD = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the line model, learnt from labels outside the held-out quarter, scores at ``GOOD`` or more."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score_quality(docs, model).where(F.col("score") >= GOOD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group linked by five-word shingles at 0.8 or more: the one with the smallest id."""
    small_batches(spark)
    gone = near_duplicates(docs, shingle=5, percent=80).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def _recounted(cut: DataFrame, columns: list[str], changed: str) -> DataFrame:
    """The columns of documents; ``n_chars`` of changed texts is counted anew, and emptied texts go."""
    rows = cut.where(F.expr(f"{changed} = 0 OR text <> ''"))
    count = F.when(F.col(changed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", count).select(*columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that an earlier equal window of 20 words covers."""
    small_batches(spark)
    return _recounted(remove_repeats(docs, window=20), docs.columns, "n_removed")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark passages of ten words."""
    return _recounted(remove_passages(docs, table(spark, sf_dir, "benchmark"), window=10), docs.columns, "n_hit")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts, by their tokens, in length buckets and token-budget batches."""
    counted = count_tokens(docs, "byte_bpe_50k.json", chunk=WHOLE, keep=False)
    return pack(counted, max_tokens=2048, buckets=12, budget=16384, length_col="n_tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: A fitted model and the choice of bucket boundaries cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

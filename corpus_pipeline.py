"""Training-corpus pipeline: classify, drop near duplicates, drop repeated passages, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept. All but the last return the columns of ``documents``; the last returns the
places of the packed pieces. ``run`` writes every stage's result as Parquet in
the session's shared folder and reads it again for the next.

A null text counts as empty throughout; an empty table passes through as one;
columns besides those of ``documents`` are dropped. A document that loses all
its words to the substring stage stays, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._common import save, table
from lodestar.llm.decontam import decontaminate
from lodestar.llm.neardup import one_of_each
from lodestar.llm.packing import pack_digest
from lodestar.llm.quality import classify
from lodestar.llm.substring import dedup_substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier doesn't reject."""
    return classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).filter("quality_kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return one_of_each(docs.select(*COLUMNS), shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of 20-word windows that start earlier elsewhere; words joined by one space."""
    kept = dedup_substrings(docs, window=20, keep=("lang", "source"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their sequence and offset."""
    return pack_digest(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: The fitted classifier and the tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

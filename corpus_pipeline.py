"""The corpus pipeline: stages over documents, each written and read again before the next.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.decontaminate import drop_contaminated
from cohortlens.llm.exact_dedup import drop_exact_copies
from cohortlens.llm.jaccard_join import drop_near_copies
from cohortlens.llm.piece_codec import piece_table
from cohortlens.llm.queries import tokenizer_file
from cohortlens.llm.shared import stash, table
from cohortlens.llm.toxicity_cnn import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents over their language's toxicity threshold go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts (A-Z lowered) the row with the largest ``doc_id`` stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word shingle similarity of 0.8 the one with the smallest ``doc_id`` stays."""
    return drop_near_copies(docs, size=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with few edits at most, go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SentencePiece ids of the documents that are left."""
    return piece_table(docs, tokenizer_file("piece_bpe_32k.model"), with_ids=True)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram jaccard join", near_dedup),
          ("benchmark decontamination", decontamination), ("sentencepiece", pieces)]

#: A trained classifier, edit matching and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline: language ID, near-duplicates, repeats, benchmark items, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreflow.llm.common import saved
from oreflow.llm.decontamination import drop_contaminated
from oreflow.llm.languages import keep_identified
from oreflow.llm.near_copies import drop_near_copies
from oreflow.llm.packing import packed
from oreflow.llm.queries import VOCABULARY, pieces, table
from oreflow.llm.repeats import drop_repeats
from oreflow.llm.tokens import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five-word shingles."""
    return drop_near_copies(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings they share with others."""
    return drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token sequences."""
    return pieces(packed(docs, vocabulary(VOCABULARY)))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained network, connected components and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the work folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Documents to packed training sequences, in stages that each read the table the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm.common import finished, free_prefix, table
from tillwatch.llm.packing import pack
from tillwatch.llm.quality import scored
from tillwatch.llm.rules import judged
from tillwatch.llm.simhash import first_of_each_group


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these documents, gives a score of 0.5 or more."""
    own = free_prefix(docs)
    rows = scored(docs, table(spark, sf_dir, "labels"), names=(f"{own}features", f"{own}score", f"{own}predicted"))
    return rows.where(F.col(f"{own}predicted") == 1).select(*[F.col(f"`{name}`") for name in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and no learned rule rejects."""
    own = free_prefix(docs)
    rows, _ = judged(docs, table(spark, sf_dir, "labels"), names=(f"{own}stats", f"{own}rule", f"{own}kept"))
    return rows.where(F.col(f"{own}kept")).select(*[F.col(f"`{name}`") for name in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return first_of_each_group(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("packing", packing),
]

# No stage can be said in SQL: two learn, one hashes shingles with XXH64, the last one tokenizes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again as the next one's documents, and removed when that is written."""

    def after(stages: list) -> DataFrame:
        if not stages:
            return table(spark, sf_dir, "documents")
        name, stage = stages[-1]
        return finished(lambda: stage(spark, after(stages[:-1]), sf_dir), name)

    return STAGES[-1][1](spark, after(STAGES[:-1]), sf_dir)

"""A training corpus from raw documents: quality, exact and near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``, with the rows that the stage keeps.
Rows are dropped by the operators' own decisions: documents scored below 0.5,
all but the largest doc_id of equal texts, all but the smallest doc_id of a
group of near duplicates (five-word shingles, similarity of 0.8 or more), and
documents that hold a benchmark passage.

Defined results of every stage: an empty table gives an empty one; texts are
read whole, however long; a null text counts as empty, and empty texts are
equal to one another, near duplicates of none and hold no passage; decisions
hold for single rows, also where ids are null or repeated, and of equal rows
one stays after exact de-duplication; all other columns, whatever their names,
are passed on. Ties go by doc_id as said above; without ids, or where they are
equal, by the digest of the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import decontamination, exact_dedup, near_dedup, packing, quality, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, percent=80, width=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: A trained classifier cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written before the next stage reads it.

    What a stage has written besides goes when its result is there, and so does
    the result before it; the last stage's tables stay until ``scratch.release``.
    """
    docs = _table(spark, sf_dir, "documents")
    before = None
    for i, (name, stage) in enumerate(STAGES):
        with scratch.scope() as work:
            docs = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            break
        table = f"{name}-{uuid.uuid4().hex}"
        docs = scratch.materialize(docs, name, table)
        scratch.discard(spark, work)
        if before:
            scratch.discard(spark, before)
        before = table
    return docs

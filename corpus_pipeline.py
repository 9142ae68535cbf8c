"""The corpus pipeline: five stages from raw documents to a shard for every training row.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes each
result as Parquet to the shared folder and hands what it reads back to the next stage.

1. language identification: documents whose language is not recognised go;
2. near-duplicates: one document of each group stays;
3. decontamination: documents that hold too much of the benchmark go;
4. mixing: every document as often as the mix of sources takes it;
5. sharding: a shard and a slot for each row of the mix.

All but the last return the columns of ``documents``. Stages 1 to 3 only take documents away,
stage 4 only repeats documents or leaves them out, by source. What SQL cannot express (the
learned stage 1) is tested against a brute-force version instead.

Defined cases, for every stage: null and empty texts have no letters and go in stage 1, the
others take them as texts without words; rows with a null or repeated doc_id are told apart by
their texts (stage 4: by all columns); of equal rows stage 2 keeps one; null languages and
sources are values like any other; further columns, whatever their names, stay as they are up
to stage 4; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.llm import decontaminate, language_id, mix, near_dedup, shard
from waferline.llm.common import fresh, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted_documents(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated. A row goes by its own key, doc_id and text, so
    rows of a null or repeated id with other texts stay."""
    row = F.xxhash64("doc_id", F.col("text").cast("string"))
    (mark,) = fresh(docs, "contaminated_row")
    found = decontaminate.decontaminate(docs.select(row.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(bad, row == F.col(mark), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard.digest(shard.assign(docs))


STAGES = [
    ("language_id", known_language),
    ("near_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("source_mix", mixed),
    ("sharding", sharded),
]

#: SQL cannot express the learned first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

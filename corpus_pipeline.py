"""From raw documents to the shards of a training corpus, in five stages.

Each stage takes the documents that the one before kept and returns a frame with
the columns of ``documents``; the last adds the shard.  Stages are written as
Parquet to the shared folder and read back, so a lost executor costs one stage.  ``run``
removes what a stage staged inside as soon as its output is written, and that output
when the next one is.

In every stage columns of any name pass as they are, and an empty table stays empty.  Texts
that are null or have no letter have no language and go with the first stage, where null
ids and repeated rows pass; of rows equal in id and text the second keeps one, as of other
copies; the third judges each row alone; the fourth keeps null sources as one source; the
last gives a shard to every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitacora.llm import contamination, language, mixing, near, shards
from bitacora.llm.text import unpacked
from bitacora.storage import Workspace, temporary

# Stages on word shingles take five words; only the query op4 has four, by its own contract.
SHINGLE = 5
# Of 0 to 1; a text scores below when no language stands out.
LEAST_LANGUAGE_SCORE = 0.3
# A typical text of a language has 1, another script 0, 20 words of random letters up to 0.16.
LEAST_LIKENESS = 0.25


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter, or like none, go.

    Where no document has a language to learn from, all with a letter stay.
    """
    model = language.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return unpacked(found.where(known & (F.col("likeness") >= LEAST_LIKENESS)), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near.representatives(docs, SHINGLE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.find_contamination(docs, items)
    return unpacked(found.where(~F.col("contaminated")), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at its budget of words; repeated in epochs, cut at the end."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and the bytes of it."""
    return unpacked(shards.assign(docs), docs.columns, F.col("shard"), F.col("shard_bytes"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Language ID is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        written = Workspace(spark)
        with temporary():
            docs, _ = written.stage(stage(spark, docs, sf_dir))
        if before:
            before.remove()
        before = written
    return docs

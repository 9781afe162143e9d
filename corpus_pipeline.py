"""A training corpus from documents, in five stages of `areacast.llm`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's documents; all but the last return the
columns of the documents.

Defined cases: null and empty texts are judged like others by every stage. Rows
of one id are one document to near-dedup, which keeps them all or none, and rows
without an id are each kept there. Extra columns, of any name, are carried. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.llm import decontaminate, mixing, quality, simhash, tokens
from areacast.llm.common import Intermediates, importable, set_apart, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; learnt from the labels."""
    importable(spark)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    docs, own = set_apart(docs, ("score", "predicted"))
    scored = quality.score_quality(docs, model)
    return scored.where(F.col("predicted") == 1).select(*own)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    importable(spark)
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the raked weights of source, language and topic."""
    return mixing.sampled(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and what reading them back gives."""
    importable(spark)
    return tokens.token_digests(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_targets", mixing_to_targets),
    ("token_output", token_output),
]

#: SQL can express neither the classifier nor the token files.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents. What they write on the way is removed,
    but for the token files, which the result reads."""
    docs = table(spark, sf_dir, "documents")
    with Intermediates(spark, "token-files"):
        for name, stage in STAGES[:-1]:
            with Intermediates(spark, "stage-"):
                docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)

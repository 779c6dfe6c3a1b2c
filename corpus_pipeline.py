"""From raw documents to a training mix: five operators, each over all that the one before kept.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next stage's documents.

1. ``toxicity``: a document that scores 0.5 or more goes. The model is fitted on the labelled documents.
2. ``near_duplicates``: of each class of near-duplicates the document with the smallest id stays.
3. ``decontaminate``: words that occur in a window of a test item go; a document of which more than
   half is such words goes whole.
4. ``personal_data``: every span found is replaced by its kind in brackets.
5. ``mix``: each source's words are brought near its target; a document comes out once for each of
   its copies, numbered in ``copy``.

Defined results: an empty table stays empty through all stages; nulls, empty and very long texts,
repeated rows and further columns are treated as each operator's docstring says; ``n_chars``
follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftledger.llm import decontaminate, mixing, pii, simhash, toxicity
from draftledger.llm.common import load, materialize

#: SQL cannot express compression lengths, fingerprints or boosted trees; tests/llm holds the
#: stages against brute-force versions.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, in the type the column has."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text")).cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_test_items),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

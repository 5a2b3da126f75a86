"""The corpus pipeline: documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), where
docs is all that the stage before kept, and returns a DataFrame.  Stages write
their result as Parquet in the shared folder and the next one rereads it, so a
lost executor costs one stage at most.  All stages but the last return the
columns of ``documents``.

1. quality classifier: poor and toxic documents go;
2. SimHash near-dedup: one document of each near-duplicate component stays;
3. benchmark decontamination: benchmark passages are cut out of the texts;
4. PII: personal data is replaced by surrogates;
5. packing: power-of-two sequences of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm import decontamination, pii, quality, simhash
from streamlens.llm.common import materialize, table
from streamlens.llm.queries import PII_KEY, packed

#: SQL cannot express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def _columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars following the text."""
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.rating())
    return quality.score(docs, model).where("keep").select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), cut=True), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(pii.replace_entities(docs, PII_KEY), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

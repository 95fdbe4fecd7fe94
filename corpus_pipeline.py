"""Documents to packed sequences: quality rules, language, near copies, personal data, packing.

Each stage takes what its predecessor kept, stored as Parquet, and all but the last
return the columns of documents.  Rows stay whole: stages drop documents, and only
the fourth changes text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import language, near_copies, packing, pii, quality
from gleanery.sources.scratch import scratch_path

#: Share of letters that one language must hold.
MIN_SHARE = 0.5
#: For repeatable results; a real run passes a secret.
KEY = b"test tables only"
#: Bytes of the batches in which tasks hand rows to Python, of which a task holds several.
BATCH_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """*stage* with the session's batches for Python bounded; its result is evaluated later, so the setting stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def _aside(docs: DataFrame, *read: str) -> DataFrame:
    """*docs* with every column that a stage doesn't read under a name that no stage uses."""
    return docs.select(*(F.col(c).alias(c if c in read else f"_own_column_{i}") for i, c in enumerate(docs.columns)))


def _back(out: DataFrame, docs: DataFrame, *read: str) -> DataFrame:
    """The columns of *docs*, under their names, of what a stage made of ``_aside``'s."""
    return out.select(*(F.col(c if c in read else f"_own_column_{i}").alias(c) for i, c in enumerate(docs.columns)))


@_in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs learnt from labels."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which some language holds at least ``MIN_SHARE`` of the letters and which fit what was learnt of it; lang stays as it was given."""
    return _back(language.keep(_aside(docs, "doc_id", "text", "lang"), MIN_SHARE), docs, "doc_id", "text", "lang")


@_in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, five-word Jaccard 0.8 or more, the document with the least id."""
    return _back(near_copies.keep_one(_aside(docs, "doc_id", "text")), docs, "doc_id", "text")


@_in_small_batches
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the new text."""
    out = _back(pii.replace(_aside(docs, "text"), KEY), docs, "text")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("packing", packed),
]

#: Tokens, hashes and models are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

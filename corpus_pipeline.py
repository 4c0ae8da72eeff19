"""A corpus pipeline out of the training-data operators.

Each stage takes all that the stage before kept, is written as Parquet and
read again. ``run`` applies the stages to ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import langid, mixing, packing, quality_bayes, simhash
from isobar.llm.common import read, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose posterior quality is below a half go."""
    return _columns(quality_bayes.good(docs, read(spark, sf_dir, "labels"), F.col("source"), F.col("lang")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents without a recognised language go."""
    return _columns(langid.identified(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each near-duplicate group stays."""
    return _columns(simhash.deduplicated(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as the mix takes it."""
    return _columns(mixing.mixed(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: pieces of all documents and their places in training sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

# The stages fit classifiers and hash shingles; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs

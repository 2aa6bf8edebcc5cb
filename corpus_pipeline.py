"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import packing
from blotter.llm.common import stage, table
from blotter.llm.exact_dedup import exact_dedup
from blotter.llm.mixing import MOST, SHARE, WEIGHTS, take
from blotter.llm.simhash import MAX_BITS, WIDTH, one_of_each
from blotter.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the calibrated trees don't call toxic."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs).kept()


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints."""
    return one_of_each(docs, WIDTH, MAX_BITS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    return take(docs, WEIGHTS, SHARE, MOST)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences."""
    pieces = packing.pack(docs, packing.CAPACITY, packing.default_ranks_path())
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("simhash", near),
    ("mixing", mixture),
    ("packing", packed),
]

#: The learned scores and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs

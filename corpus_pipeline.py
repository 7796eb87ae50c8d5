"""A corpus from documents to packed sequences: five stages, each an operator of the library applied to what the one
before kept. Rows without doc_id are judged by their text alone and stay unless it is rejected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate_hygiene.llm import decontamination, jaccard_join, line_dedup, packing, quality
from estate_hygiene.llm.workspace import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labelled ones of the table as it was, does not reject."""
    network = quality.trained(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    found = quality.scored(docs, network)
    return found.where(F.col("predicted") == 1).select(docs.columns)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; n_chars follows the text."""
    found = line_dedup.drop_shared_lines(docs)
    kept = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return found.withColumn("text", kept).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the Jaccard join links: the one of the least doc_id."""
    found = jaccard_join.jaccard_components(docs)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into; an item shorter than a seed, as a bare 'yes', drops none."""
    found = decontamination.with_leaks(docs, _read(spark, sf_dir, "benchmark"), shortest=decontamination.SEED)
    return found.where(~F.col("contaminated")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of tokens."""
    return packing.packed_sequences(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("line dedup", line_filter),
    ("n-gram jaccard join", near_duplicate_filter),
    ("benchmark decontamination", benchmark_filter),
    ("packing", pack),
]

#: The classifier and the packing have no form in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each stage's result written and read again."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

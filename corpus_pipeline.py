"""Corpus pipeline: from raw documents to packed training sequences.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that its
predecessor kept; every stage's result is written as Parquet and read back as
the next one's ``docs``.  All stages but the last return the columns of
``documents``.  The pipeline needs labelled documents (``labels``) for the
quality classifier; other defined cases are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coclick.llm import linededup, mixing, neardup, ordinal, packing
from coclick.llm.store import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal quality classifier does not reject."""
    return ordinal.select_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that five documents share, but in the largest id; n_chars follows the text."""
    kept = linededup.dedup_lines(docs, counted=False)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


#: Words a shingle of the near-dedup stage (the op7 query, with a contract of its own, takes four).
SHINGLE = 5


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates (its smallest id); documents without words stay."""
    kept = neardup.near_duplicates(docs, shingle=SHINGLE).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__kept")), "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, shuffled."""
    return mixing.mix_sources(docs, counted=False).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token spans of all documents in sequences: the pipeline's result."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

#: The classifier and the tokenizer are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

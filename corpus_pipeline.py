"""A training corpus from raw documents: five stages, each an operator of `gridloam.llm`."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloam.llm.decontaminate import without_contaminated
from gridloam.llm.jaccard_join import one_per_component
from gridloam.llm.packing import packed_documents
from gridloam.llm.quality import fit_quality, quality_of
from gridloam.llm.queries import BPE_VOCABULARY, QUALITY_THRESHOLD, held_out, table
from gridloam.llm.shipping import ship
from gridloam.llm.suffix_dedup import with_repeats_cut
from gridloam.session import fresh_path, remove, scratch

#: No single SQL statement can express training, suffix sorting and packing; tests hold each stage against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labelled rows among them, those whose
    crc32(doc_id as text) is divisible by five apart."""
    labels = table(ship(spark), sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    model = fit_quality(docs, labels)
    return docs.where(quality_of(spark, model, F.col("text")) >= QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    ship(spark)
    return one_per_component(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 400 bytes that occur twice. Lengths follow; no document is dropped."""
    ship(spark)
    return with_repeats_cut(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return without_contaminated(docs, table(ship(spark), sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences of 1024 tokens."""
    ship(spark)
    return packed_documents(docs, public_tokenizers.path(BPE_VOCABULARY))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written to the shared folder and read again. What a stage has written on
    its way is removed with the end of the stage, and its input, where an earlier stage wrote it, too; the last stage's
    stays, for its rows are made when they are asked for."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)

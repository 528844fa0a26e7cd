"""Pipeline from raw documents to packed training sequences: rules, copies, near copies, mix, packing.

Each stage takes the session, the documents its predecessor kept and the folder of the tables. All but the
last return documents with the columns of the table; rows with NULLs or empty texts are judged like others
and other columns are dropped. Rows that repeat both id and text are one document from the second stage on.
Run by itself, each stage cuts lineage as its operator does; `run` writes every stage's result to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm import exact_dedup, mixing, packing, quality_rules, simhash
from demandlake.llm.frames import DOCUMENT_COLUMNS, read, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.keep_good(docs, DOCUMENT_COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs, DOCUMENT_COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked the one with the smallest doc_id."""
    return simhash.drop_near_copies(docs, DOCUMENT_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs, DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    pieces = packing.pack(docs)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", good_documents),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Fingerprints, connected components and a public tokenizer are beyond SQL; tests compare the stages with
# brute force or, where they have a choice, with what every right outcome has in common.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

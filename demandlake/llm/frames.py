"""Small helpers shared by the operators: picking columns, stored intermediate tables, words in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.session import scratch_path

# What separates words, and a word, as the results define them.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def picked(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that no other column can clash."""
    return frame.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Lineage ends there: executors may be lost later without the work before it being repeated, and what
    is read twice is computed once.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(text: Column) -> Column:
    """NULL counts as empty."""
    return F.coalesce(text, F.lit(""))


def text_key(text: Column) -> Column:
    """The hash by which a row's text is told from others; NULL counts as empty."""
    return F.sha2(whole_text(text), 256)


def kept_rows(documents: DataFrame, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The documents named in `kept` (kept_id, kept_key, times), once each.

    `kept` holds a (doc_id, text_key) once, and how many rows carry it. Rows that repeat an id and a text are one
    document, whatever their other columns say, and only such rows are gathered by key: equal ones are combined
    before that, and of the rest the first in order of the other columns stays.
    """
    kept = stored(kept, "kept-documents")
    rows = documents.select(*columns).withColumn("text_key", text_key(F.col("text")))
    met = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    single = rows.join(kept.filter("times = 1"), met, "left_semi").select(*columns)
    if kept.filter("times > 1").isEmpty():
        return single
    several = rows.join(kept.filter("times > 1"), met, "left_semi").distinct()
    others = [c for c in columns if c not in ("doc_id", "text")]
    order = W.partitionBy("doc_id", "text_key").orderBy(*(others or ["doc_id"]))
    once = several.withColumn("row_in_order", F.row_number().over(order)).filter("row_in_order = 1")
    return single.unionByName(once.select(*columns))

"""Exact deduplication: groups by a 128-bit content hash, bytes compared inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.frames import kept_rows, picked, stored, whole_text


def exact_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by hash *and* text, so the engine compares the bytes of equal hashes and a collision
    cannot join two texts. Copies are combined before the shuffle: of a text that a third of all rows
    repeat, each task sends one row. Members then meet their group on the hash alone, without the text;
    only texts of colliding hashes, found by counting, meet on hash and text.

    NULL text is the empty text. A NULL id is never the id that stays unless the group has no other; rows
    that repeat one id are one document and share its fate (each is counted in group_size). Other columns
    are ignored. An empty table gives an empty result.
    """
    rows = picked(documents, doc_id=id_column, text=text_column).withColumn("text", whole_text(F.col("text")))
    rows = rows.withColumn("content_hash", content_hash(F.col("text")))
    best = F.max("doc_id") if keep == "largest" else F.min("doc_id")
    groups = rows.groupBy("content_hash", "text").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Every hash once, with the number of different texts below it.
    hashes = stored(
        groups.groupBy("content_hash").agg(
            F.count(F.lit(1)).alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        ),
        "exact-groups",
    )
    members = rows.select("doc_id", "content_hash", F.sha2("text", 256).alias("text_sha256"))
    result = members.join(hashes.filter("texts = 1").drop("texts"), "content_hash")
    collided = hashes.filter("texts > 1").select("content_hash")
    if not collided.isEmpty():
        rest = rows.join(collided, "content_hash", "left_semi")
        of_rest = rest.groupBy("content_hash", "text").agg(
            best.alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        result = result.unionByName(
            rest.join(of_rest, ["content_hash", "text"]).select(
                "doc_id", "content_hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
            )
        )
    return result.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(documents: DataFrame, columns: list[str]) -> DataFrame:
    """The documents without copies: of equal texts the row with the largest doc_id, once.

    Rows that repeat both id and text are one row; so are those of a text that has no other id than NULL.
    """
    kept = exact_groups(documents).filter("kept").groupBy(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_key")
    )
    return kept_rows(documents, kept.agg(F.count(F.lit(1)).alias("times")), columns)

"""Packing documents into fixed-length sequences along a Hilbert curve.

Each document's hashed token counts are projected to a few dimensions; its place on the Hilbert curve
through them orders the documents, so neighbours in a sequence resemble each other. The ids of all
documents in that order form one stream, cut every `length` ids: only the last sequence needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.frames import partitions, picked, stored
from demandlake.llm.tokens import END_ID, default_path, encoder, with_end
from demandlake.llm.words import mixed, row_slices, text_bytes

SEQUENCE_IDS = 2048
DIMENSIONS = 4
LEVELS = 15  # bits of each coordinate; the key has DIMENSIONS * LEVELS bits
FEATURES = 1024

_ENCODED = "row long, doc_id long, ids binary, n_ids long, curve long"


def projection(dimensions: int = DIMENSIONS, seed: int = 7) -> np.ndarray:
    """A fixed random projection of hashed token counts."""
    return np.random.default_rng(seed).standard_normal((FEATURES, dimensions)).astype(np.float32)


def hilbert_keys(points: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (n, dimensions) below 2**levels.

    Works down from the highest bit: each step undoes the turn of the sub-cube that the bits so far lie
    in (exchange or inversion of the lower bits), then the bits of all coordinates, Gray-decoded, are
    interleaved.
    """
    axes = points.astype(np.int64).T.copy()
    dimensions = len(axes)
    for level in range(levels - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for d in range(dimensions):
            inverted = (axes[d] & bit) != 0
            swap = np.where(inverted, 0, (axes[0] ^ axes[d]) & below)
            axes[0] = np.where(inverted, axes[0] ^ below, axes[0] ^ swap)
            axes[d] ^= swap
    for d in range(1, dimensions):
        axes[d] ^= axes[d - 1]
    turned = np.zeros_like(axes[0])
    for level in range(levels - 1, 0, -1):
        turned ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    axes ^= turned
    keys = np.zeros_like(axes[0])
    for level in range(levels - 1, -1, -1):
        for d in range(dimensions):
            keys = (keys << 1) | ((axes[d] >> level) & 1)
    return keys


def curve_places(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents whose ids lie between consecutive bounds."""
    rows = len(bounds) - 1
    feature = (mixed(ids.astype(np.uint64)) % np.uint64(FEATURES)).astype(np.int64)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    counts = np.bincount(row * FEATURES + feature, minlength=rows * FEATURES).reshape(rows, FEATURES)
    vectors = np.sqrt(counts).astype(np.float32)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    spots = vectors @ projection()
    cells = np.clip((spots + 4) / 8, 0, 1) * ((1 << LEVELS) - 1)
    return hilbert_keys(cells.astype(np.int64))


def encoded(documents: DataFrame, id_column: str, text_column: str, tokenizer_path: str) -> DataFrame:
    """Stored rows (row, doc_id, ids as unsigned 32-bit, n_ids, curve), one per document."""
    rows = picked(documents, doc_id=id_column, text=text_column)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for low, high in row_slices(offsets, 1 << 18):
                for begin in range(low, high, 1024):
                    end = min(begin + 1024, high)
                    piece = data[offsets[begin] : offsets[end]]
                    ids, bounds = encoder(tokenizer_path).encode(piece, offsets[begin : end + 1] - offsets[begin])
                    ids, bounds = with_end(ids, bounds, END_ID)
                    raw = ids.astype("<u4").tobytes()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": batch.column(0).slice(begin, end - begin),
                            "ids": pa.array(
                                [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
                                pa.binary(),
                            ),
                            "n_ids": pa.array(np.diff(bounds), pa.int64()),
                            "curve": pa.array(curve_places(ids, bounds), pa.int64()),
                        }
                    )

    made = rows.mapInArrow(compute, "doc_id long, ids binary, n_ids long, curve long")
    # The row number is given once, in what is stored, and so is the same whenever it is read.
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "packing-ids")


def starts_along_curve(rows: DataFrame) -> DataFrame:
    """(row, first): how many ids come before each document on the curve.

    Documents are range-sorted by curve key, copies of one document by their ids, so that a key that many
    share is spread over tasks. Sums per range, one row each, place the ranges.
    """
    spark = rows.sparkSession
    light = rows.select("row", "doc_id", "n_ids", "curve").withColumn("tie", F.xxhash64("doc_id"))
    ranged = light.repartitionByRange(partitions(spark), "curve", "tie", "doc_id", "row")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "packing-order")
    sums = ranged.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    ahead = F.sum("of_part").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select("part", F.coalesce(ahead, F.lit(0)).alias("base"))
    order = W.partitionBy("part").orderBy("curve", "tie", "doc_id", "row")
    inner = F.coalesce(F.sum("n_ids").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("inner", inner).join(sums, "part").select("row", (F.col("base") + F.col("inner")).alias("first"))


def pack(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    length: int = SEQUENCE_IDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit).

    The stream is cut at multiples of `length`, so every sequence but the last is full and a document lies
    in consecutive pieces. NULL text is empty and NULL ids are kept; such a document has the end id only.
    Rows that repeat an id are documents of their own. An empty table gives an empty result.
    """
    rows = encoded(documents, id_column, text_column, tokenizer_path or default_path())
    placed = rows.join(starts_along_curve(rows), "row").select("doc_id", "ids", "n_ids", "first")
    n_ids, first = F.col("n_ids"), F.col("first")
    number = F.explode(F.sequence(F.floor(first / length), F.floor((first + n_ids - 1) / length)))
    pieces = placed.withColumn("sequence_id", number).withColumns(
        {
            "start": F.greatest(F.col("sequence_id") * length - first, F.lit(0)),
            "offset": F.greatest(first - F.col("sequence_id") * length, F.lit(0)),
        }
    )
    pieces = pieces.withColumn("length", F.least(n_ids - F.col("start"), length - F.col("offset")))
    cut = F.substring("ids", (4 * F.col("start") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    return pieces.select(
        "doc_id", "start", "length", F.col("n_ids").alias("doc_tokens"), "sequence_id", "offset", cut.alias("ids")
    )

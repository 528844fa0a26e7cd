"""Hard-negative mining: exact scores by Strassen's multiplication on tiles, and mergeable heaps.

Vectors become integers once. Anchors and candidates are dealt to blocks of bounded size, a tile is one block
of anchors against one block of candidates, and each tile is a group of its own: nothing is gathered beyond
it, and a lost one is computed again by itself. Within a tile the product of the two int64 matrices comes from
Strassen's recursion with zero padding; the few best of every anchor leave it, and equal heaps of other tiles
are merged on the way to the result. Positives need tiles of one label only; negatives need all of them,
with the windows that the positives' scores set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.frames import picked, stored

# Fixed values of the contract.
POSITIVES = 5
NEGATIVES = 3
SCALE = 256
EVERY_ANCHOR = 50
EVERY_RELABELLED = 7
LABELS = 10
LEAST_SHARE, MOST_SHARE = 50, 95  # of the positive's score, in hundredths

# Rows of a block, about, and of the part of a tile whose scores are held at once.
TILE_ROWS = 4096
TILE_ANCHORS = 4096
_ANCHORS_TOGETHER = 256
# Strassen's recursion ends where a side is no longer than this.
_LEAF = 32
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = _LEAF) -> np.ndarray:
    """The product of two int64 matrices in seven half-size products a level, odd sides padded with zeros.

    Sums may wrap around on the way: arithmetic modulo 2**64 still gives the right product wherever that fits.
    """
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


# --- Points -------------------------------------------------------------------------------------


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, label, vector) with vector = floor(256 x) as little-endian int64; others take no part."""
    for batch in batches:
        vectors = batch.column(2)
        flat = vectors.flatten()
        values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        lengths = np.asarray(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(lengths)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        fine = (bad[ends] == bad[ends - lengths]) & ~np.asarray(vectors.is_null()) & ~np.asarray(batch.column(1).is_null())
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(SCALE * values)
            numbers = scaled.astype(np.int64)
        far = np.concatenate([[0], np.cumsum(np.abs(scaled) >= 2.0**62)])
        if np.any(fine & (far[ends] > far[ends - lengths])):
            raise OverflowError("a component is too large for a score of 64 bits")
        raw = [numbers[e - n : e].tobytes() for e, n in zip(ends[fine].tolist(), lengths[fine].tolist(), strict=True)]
        keep = pa.array(fine)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(raw, pa.binary())],
            ["vec_id", "label", "vector"],
        )


def points(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """The rows that take part: vec_id, label (as relabelled), vector (int64s), uid (a number of the row)."""
    rows = picked(embeddings, vec_id=id_column, label=label_column, vector=vector_column)
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    moved = F.when(F.col("vec_id") % EVERY_RELABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return (
        rows.mapInArrow(_quantised, "vec_id long, label long, vector binary")
        .withColumn("label", moved)
        .withColumn("uid", F.monotonically_increasing_id())
    )


# --- Tiles --------------------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of int64 vectors; shorter ones are padded with zeros."""
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, raw in enumerate(column.to_pylist()):
        out[i, : len(raw) // 8] = np.frombuffer(raw, "<i8")
    return out


def _sides(anchors: pa.Table, candidates: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of a tile; an error if a score might not fit 64 bits."""
    width = max((len(raw) // 8 for t in (anchors, candidates) for raw in t.column("vector").to_pylist()), default=0)
    a, b = _matrix(anchors.column("vector"), width), _matrix(candidates.column("vector"), width)
    if a.size and b.size and width * float(np.abs(a).max()) * float(np.abs(b).max()) >= 2.0**63:
        raise OverflowError("scores of these vectors may not fit 64 bits")
    return a, b


def _in_order(candidates: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Candidates by id, NULL last, so that the first of equal scores is the one to take; their ids, and which are NULL."""
    missing = np.asarray(candidates.column("vec_id").is_null())
    ids = candidates.column("vec_id").fill_null(0).to_numpy()
    order = np.lexsort((ids, missing))
    return candidates.take(pa.array(order)), ids[order], missing[order]


def _best(scores: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, score) of the best of every row, then of the second, and so on; `scores` is used up."""
    rows = np.arange(len(scores))
    for _ in range(min(count, scores.shape[1])):
        at = scores.argmax(axis=1)
        value = scores[rows, at]
        found = np.flatnonzero(value != _NONE)
        if not len(found):
            return
        yield found, at[found], value[found]
        scores[found, at[found]] = _NONE


def _ids(ids: np.ndarray, missing: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array(ids[at], pa.int64(), mask=missing[at])


def _table(parts: list[list], schema: pa.Schema) -> pa.Table:
    tables = [pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(part, schema, strict=True)], schema=schema) for part in parts]
    return pa.concat_tables(tables) if tables else schema.empty_table()


_POSITIVE = pa.schema([("uid", pa.int64()), ("anchor_id", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])
_NEGATIVE = pa.schema([("uid", pa.int64()), ("place", pa.int32()), ("found_id", pa.int64()), ("score", pa.int64())])


def _positive_tile(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    """The best rows of one label for each anchor of it; a row with the anchor's id is the anchor itself."""
    if not len(anchors) or not len(candidates):
        return _POSITIVE.empty_table()
    candidates, ids, missing = _in_order(candidates)
    a, b = _sides(anchors, candidates)
    anchor_ids, uids = anchors.column("vec_id").to_numpy(), anchors.column("uid").to_numpy()
    parts = []
    for low in range(0, len(a), _ANCHORS_TOGETHER):
        high = min(low + _ANCHORS_TOGETHER, len(a))
        scores = strassen(a[low:high], b.T)
        scores = np.where((anchor_ids[low:high, None] == ids) & ~missing, _NONE, scores)
        for row, at, value in _best(scores, POSITIVES):
            parts.append([uids[low + row], anchor_ids[low + row], _ids(ids, missing, at), value])
    return _table(parts, _POSITIVE)


def _negative_tile(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
    """For each anchor and positive the best rows of other labels whose score lies in the positive's window."""
    if not len(anchors) or not len(candidates):
        return _NEGATIVE.empty_table()
    candidates, ids, missing = _in_order(candidates)
    a, b = _sides(anchors, candidates)
    uids = anchors.column("uid").to_numpy()
    own, other = anchors.column("label").to_numpy(), candidates.column("label").to_numpy()
    scores_of = anchors.column("positive_scores").to_pylist()
    parts = []
    for low in range(0, len(a), _ANCHORS_TOGETHER):
        high = min(low + _ANCHORS_TOGETHER, len(a))
        scores = strassen(a[low:high], b.T)
        differs = own[low:high, None] != other
        for place in range(max(len(x) for x in scores_of[low:high])):
            # An anchor with fewer positives gets a window that holds nothing.
            windows = [_window(x[place]) if place < len(x) else (1, 0) for x in scores_of[low:high]]
            least, most = (np.array(side, dtype=np.int64)[:, None] for side in zip(*windows, strict=True))
            within = np.where(differs & (scores >= least) & (scores <= most), scores, _NONE)
            for row, at, value in _best(within, NEGATIVES):
                places = np.full(len(row), place, dtype=np.int32)
                parts.append([uids[low + row], places, _ids(ids, missing, at), value])
    return _table(parts, _NEGATIVE)


def _window(score: int) -> tuple[int, int]:
    """The least and greatest whole score s with 50 * score <= 100 * s <= 95 * score."""
    return -(-LEAST_SHARE * score // 100), MOST_SHARE * score // 100


def _every(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def _block(count: Column) -> Column:
    return F.pmod(F.xxhash64("uid"), count)


def _count(rows: Column, most: int) -> Column:
    return F.ceil(rows / most).cast("long")


def _merged(heaps: DataFrame, key: list[str], most: int) -> DataFrame:
    """The best of all tiles' heaps, with their rank; each task merges its own before the shuffle."""
    order = W.partitionBy(*key).orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _own_names(frame: DataFrame) -> DataFrame:
    """The frame with columns of its own, so that two frames made of one table can be told apart."""
    return frame.toDF(*frame.columns)


def _positives(rows: DataFrame, tile_anchors: int, tile_rows: int) -> DataFrame:
    is_anchor = F.coalesce(F.col("vec_id") % EVERY_ANCHOR == 0, F.lit(False))
    counts = rows.groupBy(F.col("label").alias("of_label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("n_anchors")
    )
    counts = counts.filter("n_anchors > 0").select(
        "of_label", _count(F.col("n"), tile_rows).alias("across"), _count(F.col("n_anchors"), tile_anchors).alias("down")
    )
    counted = rows.join(counts, F.col("label") == F.col("of_label"))
    anchors = counted.filter(is_anchor).select(
        "label", _block(F.col("down")).alias("a"), _every(F.col("across")).alias("c"), "vec_id", "vector", "uid"
    )
    candidates = counted.select("label", _every(F.col("down")).alias("a"), _block(F.col("across")).alias("c"), "vec_id", "vector")
    tiles = _own_names(anchors).groupBy("label", "a", "c").cogroup(_own_names(candidates).groupBy("label", "a", "c"))
    heaps = tiles.applyInArrow(_positive_tile, "uid long, anchor_id long, found_id long, score long")
    return _merged(heaps, ["uid"], POSITIVES)


def hard_negatives(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    tile_anchors: int = TILE_ANCHORS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels in the positive's window.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a NULL label, a NULL vector or a component that is NULL or not finite take no part. An id
    that is NULL is no anchor's, but the row may be found; it comes last among equal scores. Rows that share an id
    are rows of their own, but none is the other's positive, and an anchor that occurs several times is
    answered as often. Vectors of different length are filled up with zeros; components too large for
    scores of 64 bits are an error. Other columns are ignored; an empty table gives an empty result.
    """
    rows = stored(points(embeddings, id_column, vector_column, label_column), "negative-points")
    positives = stored(_positives(rows, tile_anchors, tile_rows), "negative-positives")
    is_anchor = F.coalesce(F.col("vec_id") % EVERY_ANCHOR == 0, F.lit(False))
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    across, down = F.lit(max(1, -(-n // tile_rows))).cast("long"), F.lit(max(1, -(-n_anchors // tile_anchors))).cast("long")
    by_rank = F.array_sort(F.collect_list(F.struct("rank", "score")))["score"]  # at most five
    wanted = positives.groupBy(F.col("uid").alias("p_uid")).agg(by_rank.alias("positive_scores"))
    anchors = rows.filter(is_anchor).join(wanted, F.col("uid") == F.col("p_uid"))
    anchors = anchors.select(_block(down).alias("a"), _every(across).alias("c"), "label", "vector", "uid", "positive_scores")
    candidates = rows.select(_every(down).alias("a"), _block(across).alias("c"), "vec_id", "label", "vector")
    tiles = _own_names(anchors).groupBy("a", "c").cogroup(_own_names(candidates).groupBy("a", "c"))
    heaps = tiles.applyInArrow(_negative_tile, "uid long, place int, found_id long, score long")
    best = _merged(heaps, ["uid", "place"], NEGATIVES)
    found = best.select(
        F.col("uid").alias("n_uid"), (F.col("place") + 1).alias("n_place"), "rank",
        F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    of = positives.select(
        "uid", "anchor_id", F.col("found_id").alias("positive_id"), F.col("rank").alias("place"),
        F.col("score").alias("positive_score"),
    )
    met = of.join(found, (F.col("uid") == F.col("n_uid")) & (F.col("place") == F.col("n_place")))
    return met.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Quality classifier: support vectors on naive Bayes features.

Features say whether a document has a hashed n-gram: words, word pairs, and three-byte pieces. Each is scaled
by the log of its class count ratio, counted over all labelled rows, and a linear model with hinge loss is
fitted by dual coordinate descent on at most `fit_rows` of them. A logistic curve turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from demandlake.llm.frames import picked, stored
from demandlake.llm.vectors import slot_rows, summed
from demandlake.llm.words import find_words, mixed, row_slices, text_bytes

BUCKETS = 1 << 17
#: The model is fitted on at most so many labelled rows, those with the smallest hash of their id.
FIT_ROWS = 6000
FOLDS = 5
PREDICT_FROM = 0.3
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def features(texts: pa.Array, together: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, row, bucket) of the different features of each text, in slices."""
    data, offsets = text_bytes(texts)
    for low, high in row_slices(offsets, together):
        bounds = offsets[low : high + 1] - offsets[low]
        piece = data[offsets[low] : offsets[high]]
        words = find_words(piece, bounds)
        word_row = np.repeat(np.arange(high - low), np.diff(words.first))
        pair = word_row[1:] == word_row[:-1]
        pairs = mixed(words.hashes[:-1][pair] * _PAIR + words.hashes[1:][pair])
        byte_row = np.repeat(np.arange(high - low), np.diff(bounds))
        inside = byte_row[2:] == byte_row[:-2]
        three = piece.astype(np.uint64)
        triples = mixed((three[:-2] << np.uint64(16)) + (three[1:-1] << np.uint64(8)) + three[2:] + _PAIR)[inside]
        row = np.concatenate([word_row, word_row[1:][pair], byte_row[2:][inside]])
        bucket = np.concatenate([words.hashes, pairs, triples]) % np.uint64(BUCKETS)
        keys = np.unique(row * BUCKETS + bucket.astype(np.int64))
        yield low, high, keys // BUCKETS, keys % BUCKETS


@dataclass
class QualityModel:
    """weights[bucket], a bias, and the logistic curve of the score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, rows: int, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        sums = np.bincount(row, weights=self.weights[bucket], minlength=rows)
        return sums / np.sqrt(np.maximum(np.bincount(row, minlength=rows), 1)) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -40, 40)))


def log_count_ratios(good: np.ndarray, bad: np.ndarray, n_good: float, n_bad: float) -> np.ndarray:
    """Log of how much likelier a feature is in good documents; absent features get 0."""
    ratios = np.log((good + 1) / (n_good + 2)) - np.log((bad + 1) / (n_bad + 2))
    return np.where(good + bad > 0, ratios, 0.0)


def coordinate_descent(
    samples: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, rounds: int = 12, cost: float = 1.0, seed: int = 3
) -> tuple[np.ndarray, float]:
    """Weights of the scaled features and the bias, by dual coordinate descent on the hinge loss.

    Both classes weigh the same in total.
    """
    weights, bias = np.zeros(len(ratios)), 0.0
    alphas = np.zeros(len(samples))
    signs = np.where(labels > 0, 1.0, -1.0)
    share = np.array([(signs < 0).mean(), (signs > 0).mean()])
    limits = cost * 0.5 / np.maximum(share, 1e-9)[(signs > 0).astype(int)]
    scaled = [ratios[x] / np.sqrt(max(len(x), 1)) for x in samples]
    norms = np.array([x @ x + 1.0 for x in scaled])
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in random.permutation(len(samples)).tolist():
            gap = signs[i] * (weights[samples[i]] @ scaled[i] + bias) - 1
            alpha = min(max(alphas[i] - gap / norms[i], 0.0), limits[i])
            step = (alpha - alphas[i]) * signs[i]
            if step:
                weights[samples[i]] += step * scaled[i]
                bias += step
                alphas[i] = alpha
    return weights, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the score, by Newton steps on smoothed targets."""
    n_good, n_bad = labels.sum(), (1 - labels).sum()
    goal = np.where(labels > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -40, 40)))
        spread = p * (1 - p)
        gradient = np.array([((p - goal) * margins).sum() + 1e-3 * slope, (p - goal).sum()])
        curve = np.array(
            [[(spread * margins**2).sum() + 1e-3, (spread * margins).sum()], [(spread * margins).sum(), spread.sum() + 1e-6]]
        )
        change = np.linalg.solve(curve, gradient)
        slope, shift = slope - np.clip(change[0], -2, 2), shift - np.clip(change[1], -2, 2)
    return float(max(slope, 1e-3)), float(shift)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> QualityModel:
    """Fit on the labelled documents that are not held out.

    Class counts take in all of them; only the support vectors come from at most about `fit_rows`. Of
    labels that repeat an id the smallest counts; NULL labels and ids are ignored. With labels of one class
    or none, all scores are that class's share.
    """
    known = (
        picked(labels, label_id=id_column, label=label_column)
        .filter("label is not null and label_id is not null")
        .filter(~held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg(F.min("label").cast("int").alias("label"))
        .withColumn("draw", F.xxhash64("label_id"))
    )
    drawn = known.select("draw").orderBy("draw").limit(fit_rows).agg(F.max("draw")).first()[0]
    rows = picked(documents, doc_id=id_column, text=text_column)
    # Always a shuffled join: labels grow with the documents, and so it costs alike at every size.
    joined = rows.join(known.hint("merge"), F.col("doc_id") == F.col("label_id")).select(
        "text", "label", (F.col("draw") <= F.lit(drawn)).alias("chosen")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS + 1))
        for batch in batches:
            label = batch.column(1).to_numpy()
            chosen = batch.column(2).to_numpy(zero_copy_only=False)
            for low, high, row, bucket in features(batch.column(0)):
                for side in (0, 1):
                    mine = label[low:high] == side
                    totals[side] += np.bincount(bucket[mine[row]], minlength=BUCKETS + 1)
                    totals[side, BUCKETS] += mine.sum()
                at = np.searchsorted(row, np.arange(high - low + 1))
                own = np.flatnonzero(chosen[low:high])
                if len(own):
                    raw = [bucket[at[i] : at[i + 1]].astype("<i4").tobytes() for i in own.tolist()]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "slot": pa.array(-1 - label[low:high][own], pa.int32()),
                            "piece": pa.array(raw, pa.binary()),
                        }
                    )
        yield from slot_rows(totals.reshape(-1))

    counted = stored(joined.mapInArrow(count, "slot int, piece binary"), "quality-counts")
    totals = summed(counted.filter("slot >= 0"), 2 * (BUCKETS + 1)).reshape(2, BUCKETS + 1)
    n_bad, n_good = totals[:, BUCKETS]
    if not n_bad or not n_good:
        share = (n_good + 1) / (n_good + n_bad + 2)
        return QualityModel(np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share / (1 - share))))
    ratios = log_count_ratios(totals[1, :BUCKETS], totals[0, :BUCKETS], n_good, n_bad)
    sample = counted.filter("slot < 0").orderBy(F.xxhash64("piece"), "piece").collect()
    marks = np.array([-1 - row.slot for row in sample])
    rows_of = [np.frombuffer(row.piece, "<i4") for row in sample]
    # A fifth of the sample sets the curve, the rest the weights; then all set the weights.
    last = np.arange(len(sample)) % 5 == 0
    weights, bias = coordinate_descent([x for x, y in zip(rows_of, last, strict=True) if not y], marks[~last], ratios)
    model = QualityModel(weights * ratios, bias, 1.0, 0.0)
    calibration = [x for x, y in zip(rows_of, last, strict=True) if y]
    row = np.repeat(np.arange(len(calibration)), [len(x) for x in calibration])
    bucket = np.concatenate([*calibration, np.zeros(0, np.int32)]).astype(np.int64)
    model.slope, model.shift = logistic_curve(model.margins(len(calibration), row, bucket), marks[last])
    return model


def score(documents: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. NULL text is empty and gets the bias's score."""
    rows = picked(documents, doc_id=id_column, text=text_column)
    id_type = rows.schema["doc_id"].dataType

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0)]
            for low, high, row, bucket in features(batch.column(1)):
                parts.append(model.scores(model.margins(high - low, row, bucket)))
            arrays = [batch.column(0).cast(to_arrow_type(id_type)), pa.array(np.concatenate(parts), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score"])

    scored = rows.mapInArrow(compute, f"doc_id {id_type.simpleString()}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
    )


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents and score all; ids, languages and sources are no inputs of a score.

    Rows that repeat an id each get their row (a NULL id is not held out); an empty table gives an empty
    result.
    """
    return score(documents, fit(documents, labels))

"""Language-model scores by masked pseudo-likelihood.

A small network predicts every word from the two words on each side; the sum of its log-probabilities
scores the document. Words are hashed to CLASSES * CLASSES ids, and an id is predicted in two steps, its class
and its place in the class, so a prediction costs two short softmaxes. Training runs on all documents: the
output biases start from the counts of all ids, each task descends over its own documents, and the networks of
all tasks are averaged by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from demandlake.llm.frames import picked, stored
from demandlake.llm.vectors import SLOT_SCHEMA, slot_rows, summed
from demandlake.llm.words import find_words, row_slices, text_bytes

CLASSES = 32
SIDE_WORDS = 2
HIDDEN = 16
ROUNDS = 2
RATE = 0.05
BATCH = 2048


class Network:
    """Embeddings, a scale per side position, a hidden layer and two output tables, in one flat vector."""

    def __init__(self, values: np.ndarray | None = None, seed: int = 11):
        ids, sides = CLASSES * CLASSES, 2 * SIDE_WORDS
        self.shapes = {
            "embed": (ids + 1, HIDDEN),  # the last row stands for "outside the document"
            "scale": (sides, HIDDEN),
            "class_out": (CLASSES, HIDDEN),
            "class_bias": (CLASSES,),
            "place_out": (CLASSES, CLASSES, HIDDEN),
            "place_bias": (CLASSES, CLASSES),
        }
        if values is None:
            random = np.random.default_rng(seed)
            values = np.concatenate(
                [
                    (np.ones(shape) if name == "scale" else random.standard_normal(shape) * (0.0 if "bias" in name else 0.2)).reshape(-1)
                    for name, shape in self.shapes.items()
                ]
            )
        self.values = np.array(values, np.float32)
        at = 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            setattr(self, name, self.values[at : at + size].reshape(shape))
            at += size

    # One column per word, so that sums over the short axis run along memory; columns are sorted by class.

    def hidden(self, looked: np.ndarray) -> np.ndarray:
        """The hidden layer (HIDDEN, words) of embeddings looked up (words, sides, HIDDEN)."""
        return np.ascontiguousarray(np.tanh(np.einsum("nsd,sd->nd", looked, self.scale)).T)

    def class_logits(self, hidden: np.ndarray) -> np.ndarray:
        logits = self.class_out @ hidden
        logits += self.class_bias[:, None]
        return logits

    def place_logits(self, hidden: np.ndarray, columns: list[tuple[int, slice]]) -> np.ndarray:
        """Of the places in each column's class."""
        logits = np.empty((CLASSES, hidden.shape[1]), np.float32)
        for c, own in columns:
            np.add(self.place_out[c] @ hidden[:, own], self.place_bias[c][:, None], out=logits[:, own])
        return logits

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target id given the ids beside it."""
        order, of_class, place, columns = _by_class(target)
        hidden = self.hidden(self.embed.take(context[order], axis=0))
        each = np.arange(len(target))
        out = np.empty(len(target), np.float32)
        out[order] = (
            _log_softmax(self.class_logits(hidden))[of_class, each]
            + _log_softmax(self.place_logits(hidden, columns))[place, each]
        )
        return out

    def gradient(self, context: np.ndarray, target: np.ndarray) -> Network:
        """Of the summed negative log-probability, in the shape of a network."""
        slope = Network(np.zeros_like(self.values))
        order, of_class, place, columns = _by_class(target)
        context = context[order]
        looked = self.embed.take(context, axis=0)
        hidden = self.hidden(looked)
        each = np.arange(len(target))
        error = _softmax(self.class_logits(hidden))
        error[of_class, each] -= 1
        slope.class_out += error @ hidden.T
        slope.class_bias += error.sum(axis=1)
        back = self.class_out.T @ error
        error = _softmax(self.place_logits(hidden, columns))
        error[place, each] -= 1
        for c, own in columns:
            slope.place_out[c] += error[:, own] @ hidden[:, own].T
            slope.place_bias[c] += error[:, own].sum(axis=1)
            back[:, own] += self.place_out[c].T @ error[:, own]
        hidden *= hidden
        back *= np.subtract(1, hidden, out=hidden)
        slope.scale += np.einsum("nd,nsd->sd", np.ascontiguousarray(back.T), looked)
        sides = context.T.ravel()
        for d in range(HIDDEN):
            moved = np.multiply.outer(self.scale[:, d], back[d]).ravel()
            slope.embed[:, d] += np.bincount(sides, moved, len(self.embed))
        return slope

    def start_from(self, counts: np.ndarray) -> None:
        """Biases that predict the ids by their counts alone."""
        table = counts.reshape(CLASSES, CLASSES) + 0.5
        self.class_bias[:] = np.log(table.sum(axis=1) / table.sum())
        self.place_bias[:] = np.log(table / table.sum(axis=1, keepdims=True))


class Descent:
    """Gradient steps scaled per number by the gradients met so far (Adagrad)."""

    def __init__(self, network: Network, rate: float):
        self.network, self.rate = network, rate
        self.met = np.full_like(network.values, 1e-6)
        self.room = np.empty_like(self.met)

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        slope = self.network.gradient(context, target).values
        slope /= max(len(target), 1)
        self.met += np.square(slope, out=self.room)
        slope *= self.rate
        slope /= np.sqrt(self.met, out=self.room)
        self.network.values -= slope


# Both work in the array they get: a new one of this size costs the system more than the sums in it.


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    logits -= logits.max(axis=0, initial=-np.inf)
    logits -= np.log(np.exp(logits).sum(axis=0))
    return logits


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    logits -= logits.max(axis=0, initial=-np.inf)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """(order by class, class and place of the targets in that order, the classes met with their ranges)."""
    order = np.argsort((target // CLASSES).astype(np.uint8), kind="stable")
    of_class, place = np.divmod(target[order], CLASSES)
    bounds = np.searchsorted(of_class, np.arange(CLASSES + 1))
    return order, of_class, place, [(c, slice(bounds[c], bounds[c + 1])) for c in np.unique(of_class)]


def targets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, where each row's words begin, target) of the texts, in slices."""
    data, offsets = text_bytes(texts)
    for low, high in row_slices(offsets):
        words = find_words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        yield low, high, words.first, (words.hashes % np.uint64(CLASSES * CLASSES)).astype(np.int64)


def examples(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, past the last, row, context, target) of every word of the texts, in slices."""
    outside = CLASSES * CLASSES
    for low, high, first, target in targets(texts):
        lengths = np.diff(first)
        row = np.repeat(np.arange(high - low), lengths)
        each = np.arange(len(target))
        before, after = each - first[row], first[row + 1] - 1 - each
        padded = np.concatenate([np.full(SIDE_WORDS, outside), target, np.full(SIDE_WORDS, outside)])
        context = np.empty((len(target), 2 * SIDE_WORDS), np.int64)
        for side, step in enumerate([*range(-SIDE_WORDS, 0), *range(1, SIDE_WORDS + 1)]):
            inside = before >= -step if step < 0 else after >= step
            context[:, side] = np.where(inside, padded[SIDE_WORDS + step : SIDE_WORDS + step + len(target)], outside)
        yield low, high, row, context, target


def train(documents: DataFrame, text_column: str = "text", rounds: int = ROUNDS, rate: float = RATE) -> Network:
    """A network trained on every word of every document."""
    texts = picked(documents, text=text_column)
    ids = CLASSES * CLASSES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(ids)
        for batch in batches:
            for _, _, _, target in targets(batch.column(0)):
                totals += np.bincount(target, minlength=ids)
        yield from slot_rows(totals)

    network = Network()
    network.start_from(summed(stored(texts.mapInArrow(count, SLOT_SCHEMA), "lm-counts"), ids))
    for turn in range(rounds):
        values, step = network.values, rate / (1 + turn)

        def learn(batches: Iterator[pa.RecordBatch], values=values, step=step) -> Iterator[pa.RecordBatch]:
            mine, seen = Network(values), 0
            descent = Descent(mine, step)
            for batch in batches:
                for _, _, _, context, target in examples(batch.column(0)):
                    for low in range(0, len(target), BATCH):
                        descent.step(context[low : low + BATCH], target[low : low + BATCH])
                    seen += len(target)
            if seen:
                yield from slot_rows(np.append(mine.values.astype(np.float64) * seen, seen))

        # Stored, so that adding up does not train again.
        total = summed(stored(texts.mapInArrow(learn, SLOT_SCHEMA), "lm-networks"), len(values) + 1)
        if not total[-1]:
            break
        network = Network(total[:-1] / total[-1])
    return network


def score(documents: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, log_likelihood (summed) and score (its mean per word).

    NULL and empty texts have no words, log-likelihood 0 and score NULL. Rows that repeat an id each get
    their row; an empty table gives an empty result.
    """
    rows = picked(documents, doc_id=id_column, text=text_column)
    id_type = rows.schema["doc_id"].dataType
    values = network.values

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Network(values)
        for batch in batches:
            counts, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for low, high, row, context, target in examples(batch.column(1)):
                logs = [np.zeros(0)]
                for at in range(0, len(target), 4 * BATCH):
                    logs.append(mine.log_probabilities(context[at : at + 4 * BATCH], target[at : at + 4 * BATCH]))
                counts.append(np.bincount(row, minlength=high - low))
                sums.append(np.bincount(row, weights=np.concatenate(logs), minlength=high - low))
            arrays = [
                batch.column(0).cast(to_arrow_type(id_type)),
                pa.array(np.concatenate(counts), pa.int64()),
                pa.array(np.concatenate(sums), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "log_likelihood"])

    scored = rows.mapInArrow(compute, f"doc_id {id_type.simpleString()}, n_words long, log_likelihood double")
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return scored.withColumn("score", mean)


def lm_scores(documents: DataFrame) -> DataFrame:
    """Train on all documents and score all."""
    return score(documents, train(documents))

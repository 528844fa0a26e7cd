"""Substring deduplication over word windows: Rabin-Karp hashes of all windows, counted in Spark.

Every window of `size` words is hashed; windows whose hash occurs more than once are removed, overlapping
ones merged into maximal intervals. Two windows count as equal if their 64-bit hashes are: among n windows
about n * n / 2**65 pairs would be joined wrongly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from demandlake.llm.frames import partitions, stored
from demandlake.llm.repeats import CHUNK_ITEMS, ENTRY_SCHEMA, Chunk, answers, arrow_schema, keyed, with_answers
from demandlake.llm.words import find_words, row_slices, runs, text_bytes, windows

WINDOW_WORDS = 35


def remove_repeats(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW_WORDS
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (array of word ranges), kept_text.

    A word goes if any window over it starts anywhere else too, in the same document or another; all copies
    go, the first as well. Kept words are joined by one blank. NULL text has no words; texts shorter than a
    window lose nothing; rows that repeat an id and a text are copies of each other. An empty table gives an
    empty result.
    """
    rows = keyed(documents, id_column, text_column)
    parts = partitions(documents.sparkSession)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(parts, arrow_schema(ENTRY_SCHEMA))
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_bytes(batch.column(2))
            for low, high in row_slices(offsets):
                words = find_words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                chunk.add(k1[low:high], k2[low:high], *windows(words, size))
                if chunk.items >= CHUNK_ITEMS:
                    yield from chunk.flush()
        yield from chunk.flush()

    entries = rows.select("k1", "k2", "text").mapInArrow(collect, ENTRY_SCHEMA)
    found = answers(entries, parts).drop("hot", "n")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)

    def finish(doc_id, text: bytes, key, begins: np.ndarray, ends: np.ndarray) -> list[tuple]:
        words = text.split()
        if not len(begins):
            return [(doc_id, len(words), 0, [], b" ".join(words))]
        steps = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(steps, begins, 1)
        np.add.at(steps, np.minimum(ends - 1 + size, len(words)), -1)
        gone = np.cumsum(steps[:-1]) > 0
        spans = [{"begin": int(a), "end": int(b)} for a, b in zip(*runs(gone), strict=True)]
        kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
        return [(doc_id, len(words), int(gone.sum()), spans, b" ".join(kept))]

    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def make(done: list) -> Iterator[pa.RecordBatch]:
        doc_id, n_words, n_removed, spans, kept = zip(*done, strict=True)
        arrays = [
            pa.array(doc_id, id_arrow),
            pa.array(n_words, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array(spans, span_type),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    schema = (
        f"doc_id {id_type}, n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept_text string"
    )
    return with_answers(rows, stored(found, "repeated-windows"), parts, finish, schema, make)

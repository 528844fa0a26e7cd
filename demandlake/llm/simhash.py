"""SimHash near-duplicates by multi-index hashing.

The 64-bit fingerprint is cut into segments. Around each segment's value the ball of Hamming radius 1 is
enumerated, the other segments staying as they are, and every member is an entry of the index. Two
fingerprints within distance 2 share an entry: each gives up one of the differing bits. An entry holds at
most 65 different fingerprints (those within one bit of it), whatever the data, so no bucket can grow; all
of them lie within distance 2 of each other, so linking each to the smallest of its entry keeps every
component and no pairs are written out. The complete distance is verified for each link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.components import connected_components
from demandlake.llm.frames import kept_rows, picked, stored, text_key

BITS = 64
SEGMENTS = 2
MOST_BITS = 2
SHINGLE_WORDS = 3
SHINGLE_SEED = 42
_TOGETHER = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE_WORDS, seed: int = SHINGLE_SEED) -> int:
    """SimHash of one text as a signed 64-bit number; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z become lower case, only the six ASCII spaces cut
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) < size:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    counts = np.zeros(BITS, dtype=np.int64)
    for low in range(0, len(starts), _TOGETHER):
        cuts = map(slice, starts[low : low + _TOGETHER].tolist(), ends[low : low + _TOGETHER].tolist())
        hashes = np.array(list(map(digest, map(joined.__getitem__, cuts))), dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.int64)[0])


def fingerprints(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row (doc_id, fingerprint, text_key) per document; NULL text has no words."""
    rows = picked(documents, doc_id=id_column, text=text_column).withColumn("text_key", text_key(F.col("text")))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint((text.as_py() or "").encode(), shingle_words) for text in batch.column(1)]
            columns = [batch.column(0), pa.array(values, pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", "text_key"])

    return rows.mapInArrow(compute, f"doc_id {id_type}, fingerprint long, text_key string")


def fingerprint_links(values: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) between different fingerprints within two bits, enough to keep all components."""
    if BITS % segments:
        raise ValueError(f"{segments} segments do not divide {BITS} bits")
    width = BITS // segments
    value = F.col("fingerprint")
    entries = [F.array(value)]
    for segment in range(segments):
        bits = F.sequence(F.lit(segment * width), F.lit((segment + 1) * width - 1))
        entries.append(F.transform(bits, lambda bit: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))))
    index = values.select("fingerprint", F.explode(F.concat(*entries)).alias("entry"))
    smallest = F.min("fingerprint").over(W.partitionBy("entry"))
    links = index.withColumn("b", smallest).filter("fingerprint <> b")
    verified = links.filter(F.bit_count(value.bitwiseXOR(F.col("b"))) <= MOST_BITS)
    return verified.select(F.col("fingerprint").alias("a"), "b").distinct()


def _in_components(prints: DataFrame) -> DataFrame:
    """The rows of `prints` with the root of their component, a fingerprint, and its smallest doc_id."""
    values = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprint-values")
    roots = connected_components(fingerprint_links(values), "simhash")
    rooted = values.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(smallest, "root").select("fingerprint", "root", "component_id"), "fingerprint")


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per document: doc_id, fingerprint (signed 64-bit number), component_id.

    component_id is the smallest doc_id that links of at most two differing bits lead to. Copies share a
    fingerprint and are combined before anything is searched. A NULL id is never a component_id unless its
    component has no other; documents without words share fingerprint 0. Rows that repeat an id each get
    their row. An empty table gives an empty result.
    """
    prints = stored(fingerprints(documents, id_column, text_column, shingle_words), "fingerprints")
    return _in_components(prints).select("doc_id", "fingerprint", "component_id")


def drop_near_copies(documents: DataFrame, columns: list[str], shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Of each component of near duplicates the row with the smallest doc_id, once.

    A NULL id is the largest; of rows that share an id the one whose text has the smallest hash stays.
    """
    prints = stored(fingerprints(documents, shingle_words=shingle_words), "fingerprints")
    rows = _in_components(prints).groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "times"))
    kept = rows.groupBy("root").agg(first.alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_key").alias("kept_key"), "kept.times")
    return kept_rows(documents, kept, columns)

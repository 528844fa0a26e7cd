"""Token ids as bit-packed binary files with block offsets, written and read by Spark tasks.

A file holds documents one after the other: the payload, in blocks of BLOCK_IDS ids of `bits` bits each
(little end first, every block on a byte of its own), then the table of block offsets, the table of
documents (id, NULL flag, end of its ids) and a fixed trailer. Any block is found by its offset and
unpacked with a few numpy calls, so any range of ids can be read without the rest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.frames import partitions, picked, whole_text
from demandlake.llm.tokens import END_ID, default_path, encoder, vocabulary_size, with_end
from demandlake.llm.words import row_slices, text_bytes
from demandlake.session import scratch_path

MAGIC = b"DLTOKENS"
BLOCK_IDS = 1 << 14
# magic, bits, ids a block, blocks, documents, ids, where the block table starts
_TRAILER = struct.Struct("<8sIIQQQQ")

_MANIFEST = "shard long, path string, documents long, ids long"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids in `bits` bits each, little end first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    table = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(table.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    table = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=count * bits).reshape(count, bits)
    return table.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class TokenFileWriter:
    """Writes one file, block by block; holds one block of ids and the tables."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.position = 0
        self.blocks: list[int] = []
        self.doc_ids: list[int | None] = []
        self.ends: list[np.ndarray] = []

    def add(self, doc_ids: list, ids: np.ndarray, bounds: np.ndarray) -> None:
        """Documents with their ids end to end; bounds has one entry more than documents."""
        self.doc_ids.extend(doc_ids)
        self.ends.append(self.n_ids + bounds[1:])
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids:
            self._flush(self.n_waiting // self.block_ids * self.block_ids)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting)
        for low in range(0, count, self.block_ids):
            raw = pack(ids[low : min(low + self.block_ids, count)], self.bits)
            self.blocks.append(self.position)
            self.sink.write(raw)
            self.position += len(raw)
        self.waiting = [ids[count:]]
        self.n_waiting -= count

    def close(self) -> None:
        if self.n_waiting:
            self._flush(self.n_waiting)
        table_at = self.position
        self.sink.write(np.array(self.blocks, dtype="<u8").tobytes())
        self.sink.write(np.array([x or 0 for x in self.doc_ids], dtype="<i8").tobytes())
        self.sink.write(np.array([x is None for x in self.doc_ids], dtype=np.uint8).tobytes())
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0)
        self.sink.write(ends.astype("<u8").tobytes())
        self.sink.write(
            _TRAILER.pack(MAGIC, self.bits, self.block_ids, len(self.blocks), len(self.doc_ids), self.n_ids, table_at)
        )


class TokenFileReader:
    """Random access to one file: the tables are read at once, ids block by block when asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - _TRAILER.size)
        magic, self.bits, self.block_ids, blocks, documents, self.n_ids, self.table_at = _TRAILER.unpack(
            source.read(_TRAILER.size)
        )
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(self.table_at)
        self.blocks = np.frombuffer(source.read(8 * blocks), "<u8").astype(np.int64)
        raw_ids = np.frombuffer(source.read(8 * documents), "<i8").tolist()
        nulls = np.frombuffer(source.read(documents), np.uint8).tolist()
        self.doc_ids = [None if null else x for x, null in zip(raw_ids, nulls, strict=True)]
        self.ends = np.frombuffer(source.read(8 * documents), "<u8").astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the file, from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        upto = self.blocks[last + 1] if last + 1 < len(self.blocks) else self.table_at
        begin = int(self.blocks[first])
        self.source.seek(begin)
        raw = self.source.read(int(upto) - begin)
        parts = []
        for block in range(first, last + 1):
            count = min(self.block_ids, self.n_ids - block * self.block_ids)
            parts.append(unpack(raw[int(self.blocks[block]) - begin :], self.bits, count))
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]


def _opened(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


def write_token_files(
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    shards: int | None = None,
) -> DataFrame:
    """Encode all documents into files below `path`, in ascending id order; returns the stored manifest.

    Manifest rows are (shard, path, documents, ids); shards follow each other in id order. A task writes a
    file under a name of its own and only then reports it, so a repeated or lost task leaves at most a file
    that no manifest names. NULL ids come first, rows with one id are ordered by text, NULL text is empty:
    its only id is the end id. An empty table gives no files and an empty manifest.
    """
    tokenizer_path = tokenizer_path or default_path()
    rows = picked(documents, doc_id=id_column, text=text_column).withColumn("text", whole_text(F.col("text")))
    shards = shards or partitions(documents.sparkSession)
    ordered = rows.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, name, writer, sink = None, "", None, None
        system, folder = _opened(path)
        bits = max(1, (vocabulary_size(tokenizer_path) - 1).bit_length())
        context = TaskContext.get()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(folder, recursive=True)
                name = f"tokens-{context.partitionId():06d}-{uuid.uuid4().hex}.bin"
                target = f"{folder}/{name}"
                sink = system.open_output_stream(target)
                writer = TokenFileWriter(sink, bits)
            data, offsets = text_bytes(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for low, high in row_slices(offsets):
                piece = data[offsets[low] : offsets[high]]
                ids, bounds = encoder(tokenizer_path).encode(piece, offsets[low : high + 1] - offsets[low])
                writer.add(doc_ids[low:high], *with_end(ids, bounds, END_ID))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([context.partitionId()], pa.int64()),
                    "path": pa.array([f"{path}/{name}"], pa.string()),
                    "documents": pa.array([len(writer.doc_ids)], pa.int64()),
                    "ids": pa.array([writer.n_ids], pa.int64()),
                }
            )

    # Written at once: the files exist when the manifest does, and no task runs twice for it.
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{path}/manifest")
    return documents.sparkSession.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    `start` counts the ids of all documents before it. A running sum over the manifest, one row per file,
    places the files; each is then read by one task, some blocks at a time.
    """
    before = F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    files = manifest.withColumn("first", F.coalesce(before, F.lit(0))).select("path", "first", "shard")
    spread = files.repartition(max(1, partitions(manifest.sparkSession)), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, name = _opened(path)
                with system.open_input_file(name) as source:
                    yield from _documents(TokenFileReader(source), first)

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _documents(reader: TokenFileReader, first: int, together: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    ends, low = reader.ends, 0
    while low < len(ends):
        begin = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, begin + together, side="right")))
        ids = reader.read(begin, int(ends[high - 1])).astype("<u4")
        starts = np.concatenate([[begin], ends[low : high - 1]])
        raw = [ids[a - begin : b - begin].tobytes() for a, b in zip(starts.tolist(), ends[low:high].tolist(), strict=True)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(reader.doc_ids[low:high], pa.int64()),
                "start": pa.array(first + starts, pa.int64()),
                "n_tokens": pa.array(ends[low:high] - starts, pa.int64()),
                "ids": pa.array(raw, pa.binary()),
            }
        )
        low = high


def token_files(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write all documents to token files in the shared folder and read them back."""
    path = scratch_path(documents.sparkSession, "tokens")
    return read_token_files(write_token_files(documents, path, tokenizer_path=tokenizer_path))


def crc32(raw: bytes) -> int:
    return zlib.crc32(raw)

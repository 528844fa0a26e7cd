"""Finding items (hashed pieces of texts) that occur more than once, anywhere in a table.

Map side: a task takes the items of many rows together, one chunk, and sorts their hashes. Items repeated in
the chunk are answered at once; of every different hash one entry goes on, in blobs of plain arrays, to
the partition its hash belongs to. There the entries of all chunks meet; a hash with two entries, or one that
repeated within a chunk, is a repeat, and its entries are sent home. A hash that most rows share thus
reaches its partition once per chunk, not once per row.

Rows are known by a 96-bit key of their id and text. Rows equal in both share it, and share their answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.frames import whole_text

CHUNK_ITEMS = 3_000_000

#: A row is a blob of entries for partition `part`, or a blob of answers for the rows that `part` has.
ENTRY_SCHEMA = (
    "part int, keys binary, begins binary, lengths binary,"
    " hashes binary, places binary, again binary, again_counts binary"
)
#: Answers; `hot` and `n` name a hash with many occurrences.
ANSWER_SCHEMA = "part int, keys binary, begins binary, lengths binary, hot long, n long"

_KEY = np.dtype([("k1", "<i8"), ("k2", "<i4"), ("n", "<u4")])


def keyed(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows (k1, k2, doc_id, text); NULL text is empty."""
    text = whole_text(F.col(f"`{text_column}`"))
    doc_id = F.col(f"`{id_column}`")
    return documents.select(
        F.xxhash64(doc_id, text).alias("k1"), F.hash(text, doc_id).alias("k2"), doc_id.alias("doc_id"), text.alias("text")
    )


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values byte by byte, all low bytes first: high bytes are mostly 0 and compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    table = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(table.T).view("<u4").reshape(-1).astype(np.int64)


def _ascending_deltas(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    deltas = place.astype(np.int64).copy()
    same = doc[1:] == doc[:-1]
    deltas[1:][same] -= place[:-1][same]
    return deltas


def _groups(values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]]) if len(values) else (
        np.zeros(1, np.int64)
    )


def span_pairs(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive places of ascending (doc, place): doc, first place, one past the last."""
    if not len(doc):
        return doc, place, place
    cut = np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], place[first], place[last] + 1


def key_blob(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray) -> bytes:
    """Keys of the runs of equal docs, with their lengths."""
    bounds = _groups(doc)
    keys = np.zeros(len(bounds) - 1, dtype=_KEY)
    keys["k1"], keys["k2"], keys["n"] = k1[doc[bounds[:-1]]], k2[doc[bounds[:-1]]], np.diff(bounds)
    return keys.tobytes()


def answer_rows(k1, k2, doc, begin, end, parts: int) -> dict[str, list]:
    """One row for each part: the ranges found in its rows, as plain arrays. Ranges come in ascending order."""
    out: dict[str, list] = {"part": [], "keys": [], "begins": [], "lengths": []}
    part = np.mod(k1, parts)[doc]
    order = np.argsort(part, kind="stable")
    bounds = _groups(part[order])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        mine = order[a:b]
        out["part"].append(int(part[mine[0]]))
        out["keys"].append(key_blob(k1, k2, doc[mine]))
        out["begins"].append(planes(_ascending_deltas(doc[mine], begin[mine])))
        out["lengths"].append(planes((end - begin)[mine]))
    return out


def placed(keys: np.ndarray, deltas: np.ndarray) -> np.ndarray:
    """Places from deltas that start anew with every key."""
    sums = np.cumsum(deltas)
    starts = np.cumsum(keys["n"].astype(np.int64)) - keys["n"]
    return sums - np.repeat(sums[starts] - deltas[starts], keys["n"])


def batch_of(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    arrays = [pa.array(columns.get(f.name, [None] * size), f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def arrow_schema(text: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (x.split() for x in text.split(","))])


class Chunk:
    """Items of many rows, up to CHUNK_ITEMS, and what becomes of them.

    With `keep_first` the smallest (key, place) of each hash is its entry, and only the others are answered here.
    """

    def __init__(self, parts: int, schema: pa.Schema, keep_first: bool = False):
        self.parts, self.schema, self.keep_first = parts, schema, keep_first
        self._clear()

    def _clear(self) -> None:
        self.hashes: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.k1: list[np.ndarray] = []
        self.k2: list[np.ndarray] = []
        self.items = self.rows = 0

    def add(self, k1, k2, row, place, hashes) -> None:
        """Items in ascending (row, place) of the rows with these keys."""
        self.hashes.append(hashes)
        self.docs.append((row + self.rows).astype(np.int32))
        self.places.append(place.astype(np.int32))
        self.k1.append(k1)
        self.k2.append(k2)
        self.items += len(hashes)
        self.rows += len(k1)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.items:
            self._clear()
            return
        hashes, docs, places = map(np.concatenate, (self.hashes, self.docs, self.places))
        k1, k2 = np.concatenate(self.k1), np.concatenate(self.k2)
        self._clear()
        order = np.lexsort((places, k2[docs], k1[docs], hashes)) if self.keep_first else np.argsort(hashes)
        bounds = _groups(hashes[order])
        counts = np.diff(bounds)
        repeated = np.zeros(len(hashes), dtype=bool)
        repeated[order[np.repeat(counts > 1, counts)]] = True
        chosen, chosen_counts = order[bounds[:-1]], counts
        if self.keep_first:
            first = np.repeat(chosen, counts)
            repeated[order] = _later(k1[docs[order]], k2[docs[order]], places[order], k1[docs[first]], k2[docs[first]], places[first])
            chosen_counts = np.ones_like(counts)
        del order
        yield batch_of(answer_rows(k1, k2, *span_pairs(docs[repeated], places[repeated]), self.parts), self.schema)
        # One entry per different hash: those of one place with it, the others with their number.
        single = np.sort(chosen[chosen_counts == 1])
        again = chosen[chosen_counts > 1]
        again_counts = chosen_counts[chosen_counts > 1]
        by_part = [_by_part(hashes[x], self.parts) for x in (single, again)]
        out: dict[str, list] = {x: [] for x in ("part", "hashes", "keys", "places", "again", "again_counts")}
        for part in range(self.parts):
            mine = single[by_part[0][0][by_part[0][1][part] : by_part[0][1][part + 1]]]
            pick = by_part[1][0][by_part[1][1][part] : by_part[1][1][part + 1]]
            if not len(mine) and not len(pick):
                continue
            doc, place = docs[mine], places[mine]
            out["part"].append(part)
            out["hashes"].append(hashes[mine].tobytes())
            out["keys"].append(key_blob(k1, k2, doc))
            out["places"].append(planes(_ascending_deltas(doc, place)))
            out["again"].append(hashes[again[pick]].tobytes())
            out["again_counts"].append(again_counts[pick].astype("<u4").tobytes())
        yield batch_of(out, self.schema)


def _later(k1, k2, place, first_k1, first_k2, first_place) -> np.ndarray:
    """Which places are not the first one. Rows that repeat a key have the same places."""
    return (k1 != first_k1) | (k2 != first_k2) | (place != first_place)


def _by_part(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by partition (stable) and the bounds of each partition."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


class Entries:
    """The entries that one partition gets."""

    def __init__(self):
        self.hashes, self.keys, self.deltas, self.again, self.counts = [], [], [], [], []

    def add(self, hashes: bytes, keys: bytes, deltas: bytes, again: bytes, counts: bytes) -> None:
        self.hashes.append(np.frombuffer(hashes, np.uint64))
        self.keys.append(np.frombuffer(keys, _KEY))
        self.deltas.append(deltas)
        self.again.append(np.frombuffer(again, np.uint64))
        self.counts.append(np.frombuffer(counts, "<u4"))

    def answers(self, parts: int, hot_from: int | None = None, keep_first: bool = False) -> Iterator[dict[str, list]]:
        """The repeated places, with `keep_first` without the smallest (key, place) of each hash."""
        if not self.hashes:
            return
        if hot_from is not None:  # the number of all items, for the caller to judge what is hot
            items = sum(map(len, self.hashes)) + sum(int(x.sum()) for x in self.counts)
            yield {"hot": [None], "n": [items]}
        again, counts = np.concatenate(self.again), np.concatenate(self.counts)
        everything = np.sort(np.concatenate([*self.hashes, again]))
        known = np.union1d(everything[1:][everything[1:] == everything[:-1]], again)
        del everything
        if not len(known):
            return
        total = np.zeros(len(known), dtype=np.int64)
        np.add.at(total, np.searchsorted(known, again), counts)
        found = []
        for hashes, keys, deltas in zip(self.hashes, self.keys, self.deltas, strict=True):
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            if hit.any():
                np.add.at(total, at[hit], 1)
                doc = np.repeat(np.arange(len(keys)), keys["n"])[hit]
                used, doc = np.unique(doc, return_inverse=True)
                found.append((keys[used], doc, placed(keys, from_planes(deltas))[hit], at[hit]))
        if found:
            keys, docs, places, of_hash = zip(*found, strict=True)
            before = np.cumsum([0, *map(len, keys)])[:-1]
            doc = np.concatenate([d + n for d, n in zip(docs, before, strict=True)])
            place, keys = np.concatenate(places), np.concatenate(keys)
            k1, k2 = keys["k1"].astype(np.int64), keys["k2"].astype(np.int64)
            if keep_first:
                of_hash = np.concatenate(of_hash)
                order = np.lexsort((place, k2[doc], k1[doc], of_hash))
                bounds = _groups(of_hash[order])
                first = np.empty(len(order), dtype=np.int64)
                first[order] = np.repeat(order[bounds[:-1]], np.diff(bounds))
                later = _later(k1[doc], k2[doc], place, k1[doc[first]], k2[doc[first]], place[first])
                doc, place = doc[later], place[later]
            if len(doc):
                yield answer_rows(k1, k2, doc, place, place + 1, parts)
        if hot_from is not None and (total >= hot_from).any():
            many = total >= hot_from
            yield {"hot": known[many].view(np.int64).tolist(), "n": total[many].tolist()}


def answers(entries: DataFrame, parts: int, hot_from: int | None = None) -> DataFrame:
    """Entries moved to their partition and answered; answers given on the map side pass through.

    With `hot_from`, rows (hot, n) name hashes that occur so often, and rows (NULL, n) count all items.
    """
    moved = entries.repartitionById(parts, F.col("part"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(ANSWER_SCHEMA)
        gathered = Entries()
        for batch in batches:
            blob = batch.column("hashes").is_valid()
            plain = batch.filter(pc.invert(blob)).select(["part", "keys", "begins", "lengths"])
            if plain.num_rows:
                yield batch_of(plain.to_pydict(), schema)
            for row in batch.filter(blob).to_pylist():
                gathered.add(row["hashes"], row["keys"], row["places"], row["again"], row["again_counts"])
        for out in gathered.answers(parts, hot_from):
            yield batch_of(out, schema)

    return moved.mapInArrow(answer, ANSWER_SCHEMA)


class Answers:
    """The answers for one partition's rows, looked up by key."""

    def __init__(self):
        self.blobs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.k1: np.ndarray | None = None

    def add(self, keys: bytes, begins: bytes, lengths: bytes) -> None:
        table = np.frombuffer(keys, _KEY)
        begin = placed(table, from_planes(begins))
        self.blobs.append((table, begin.astype(np.int32), (begin + from_planes(lengths)).astype(np.int32)))

    def _close(self) -> None:
        tables, begins, ends = zip(*self.blobs, strict=True) if self.blobs else ((), (), ())
        keys = np.concatenate([np.zeros(0, _KEY), *tables])
        k1, k2 = np.repeat(keys["k1"], keys["n"]), np.repeat(keys["k2"], keys["n"])
        order = np.argsort(k1, kind="stable")
        self.k1, self.k2 = k1[order], k2[order]
        self.begins = np.concatenate([np.zeros(0, np.int32), *begins])[order]
        self.ends = np.concatenate([np.zeros(0, np.int32), *ends])[order]
        self.blobs = []

    def of(self, k1: int, k2: int) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the ranges found in a row."""
        if self.k1 is None:
            self._close()
        low, high = np.searchsorted(self.k1, k1, side="left"), np.searchsorted(self.k1, k1, side="right")
        if low == high:
            return self.begins[:0], self.ends[:0]
        own = self.k2[low:high] == k2
        return self.begins[low:high][own].astype(np.int64), self.ends[low:high][own].astype(np.int64)


def with_answers(
    rows: DataFrame,
    found: DataFrame,
    parts: int,
    finish: Callable,
    schema: str,
    make: Callable[[list], Iterator[pa.RecordBatch]],
    bytes_together: int = 4_000_000,
) -> DataFrame:
    """Each row of `keyed` with its answers: finish(doc_id, text, key, begins, ends) -> list of results.

    A partition reads its answers first and then its texts as a stream. `make` turns lists of results into
    batches; results are passed on every `bytes_together` bytes of text.
    """
    none = F.lit(None).cast("binary")
    texts = rows.withColumn("part", F.pmod(F.col("k1"), F.lit(parts)).cast("int")).withColumns(
        {"keys": none, "begins": none, "lengths": none}
    )
    given = found.filter("keys is not null").select("part", "keys", "begins", "lengths")
    together = texts.unionByName(given, allowMissingColumns=True)
    together = together.repartitionById(parts, F.col("part")).sortWithinPartitions(F.col("text").isNotNull())
    together = together.select("k1", "k2", "doc_id", "text", "keys", "begins", "lengths")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done, size = Answers(), [], 0
        for batch in batches:
            blobs = batch.column("text").is_null()
            for row in batch.filter(blobs).select(["keys", "begins", "lengths"]).to_pylist():
                known.add(row["keys"], row["begins"], row["lengths"])
            batch = batch.filter(pc.invert(blobs))
            keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
            for i, key in enumerate(keys):
                text = batch.column("text")[i].as_py().encode()
                done.extend(finish(batch.column("doc_id")[i].as_py(), text, key, *known.of(*key)))
                size += len(text)
                if size > bytes_together:
                    if done:
                        yield from make(done)
                    done, size = [], 0
        if done:
            yield from make(done)

    return together.mapInArrow(merge, schema)

"""Substring deduplication over bytes, by suffix order and longest-previous-factor tests.

Texts that share a string of `size` bytes also share the string's anchor: the piece of ANCHOR bytes with the
smallest hash in it (leftmost on ties). Stages:

1. The anchors of all strings of `size` bytes are counted like any repeated items (see `repeats`).
2. Around each repeated anchor the bytes of all strings it is the anchor of form a segment, sent to the
   partition of the anchor. Equal segments of a task are sent once.
3. There the segments are put in suffix order for every distance from the anchor: the right parts are sorted
   once, and each step to the left is one stable sort by one byte. Strings that agree in `size` bytes are
   neighbours in it. Longest common prefixes come from range minima over the right parts. A position's longest
   previous factor, cut off at `size` bytes, is the longer of its common prefixes with the previous and the next
   smaller position in suffix order: if it has `size` bytes, the position is a later copy and may go. The longest
   next factor, from the previous and next larger positions, finds the copies that have only later ones.

An anchor that occurs in HOT_LEAST places, and in more than one of HOT_SHARE, would gather too much in one task;
there are at most HOT_SHARE such anchors, 16 MB in all. The strings around these are compared by 64-bit hash instead, as items of
their own, so that no task gets more than one entry per string and chunk: with keep="first" the chunk's first
place, so that the first of all is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from demandlake.llm.frames import partitions, stored
from demandlake.llm.repeats import (
    CHUNK_ITEMS,
    ENTRY_SCHEMA,
    Chunk,
    Entries,
    answer_rows,
    answers,
    arrow_schema,
    batch_of,
    keyed,
    span_pairs,
    with_answers,
)
from demandlake.llm.words import SLICE_BYTES, mixed, prefix_sums, range_hashes, row_slices, runs, text_bytes

MATCH_BYTES = 400
ANCHOR_BYTES = 64
HOT_SHARE = 2_000_000
HOT_LEAST = 2_000
BATCH_SEGMENTS = 1 << 12

_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = np.uint64(21)  # a slice has fewer bytes than this many bits can count
_SEGMENT_SCHEMA = ENTRY_SCHEMA + ", k1 long, k2 int, anchor long, low int, high int, middle int, bytes binary"
_ANSWER = "part int, keys binary, begins binary, lengths binary"


def _pieces(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, past the last, place of the slice in its row, bytes, bounds); long rows in overlapping ones."""
    for low, high in row_slices(offsets):
        begin, end = int(offsets[low]), int(offsets[high])
        if end - begin <= SLICE_BYTES:
            yield low, high, 0, data[begin:end], offsets[low : high + 1] - begin
            continue
        for at in range(begin, end, SLICE_BYTES):
            stop = min(at + SLICE_BYTES + size - 1, end)
            yield low, high, at - begin, data[at:stop], np.array([0, stop - at])


def _hashes(piece: np.ndarray, size: int) -> np.ndarray:
    count = len(piece) - size + 1
    sums = prefix_sums(piece.astype(np.uint64) + np.uint64(1), _BASE)
    at = np.arange(count)
    return mixed(range_hashes(sums, _BASE, at, at + size))


def _least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbouring values: block-wise minima from both sides."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchor_runs(piece: np.ndarray, bounds: np.ndarray, size: int, anchor: int):
    """Runs of starts of `size`-byte strings with one anchor: row, first start, last start, anchor, its hash."""
    count = len(piece) - size + 1
    if count <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    hashes = _hashes(piece, anchor)
    mask = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    ranked = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    least = (_least_in_window(ranked, size - anchor + 1) & mask).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:count]
    valid = np.arange(count) + size <= bounds[1:][row]
    cut = np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (valid[1:] != valid[:-1])])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], count) - 1
    good = valid[first]
    first, last = first[good], last[good]
    middle = least[first]
    # Least hashes are small; mixed once more, they spread over all partitions.
    start = bounds[row[first]]
    return row[first], first - start, last - start, middle - start, mixed(hashes[middle])


def _range_minima(values: np.ndarray):
    """Function giving the minimum of values[p:q] for arrays p < q."""
    table = [values]
    width = 1
    while 2 * width <= len(values):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2

    def least(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        level = np.frexp((q - p).astype(np.float64))[1] - 1
        out = np.empty(len(p), dtype=values.dtype)
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(table[k][p[at]], table[k][q[at] - (1 << k)])
        return out

    return least


def nearer_positions(position: np.ndarray, common: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factors, cut off at `size`, of suffixes in their order.

    `common` holds the common prefixes of neighbours, cut off at `size`. Within a run of neighbours that agree in
    `size` bytes all agree, so the factor of an element is `size` if the run holds a smaller (larger) position
    before or after it, and else ends at the run's edge: it is below `size`, and 0 stands for it.
    """
    run = np.concatenate([[0], np.cumsum(common < size)])
    # Runs shifted apart, so that a running minimum or maximum never looks into the run before.
    span = np.int64(position.max(initial=0) + 1)
    previous_smaller = np.minimum.accumulate(position - run * span) < position - run * span
    next_smaller = (np.minimum.accumulate((position + run * span)[::-1]) < (position + run * span)[::-1])[::-1]
    previous_larger = np.maximum.accumulate(position + run * span) > position + run * span
    next_larger = (np.maximum.accumulate((position - run * span)[::-1]) > (position - run * span)[::-1])[::-1]
    return np.where(previous_smaller | next_smaller, size, 0), np.where(previous_larger | next_larger, size, 0)


def repeated_starts(
    raw: np.ndarray, begins: np.ndarray, low: np.ndarray, high: np.ndarray, middle: np.ndarray, rank: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts whose string of `size` bytes another segment has too: segment, start, and whether it is a later copy.

    Segment i holds the bytes from its place low[i] to high[i] + size; `rank` orders the segments by their
    place in the texts.
    """
    count = len(begins)
    to_anchor = middle - low
    rights = np.minimum(high + size - middle, size)
    at = begins + to_anchor
    columns = np.arange(size)
    right = np.where(columns < rights[:, None], raw[np.minimum(at[:, None] + columns, len(raw) - 1)], 0).astype(np.uint8)
    order = np.argsort(np.ascontiguousarray(right).view(f"S{size}").ravel(), kind="stable")
    same = right[order[1:]] == right[order[:-1]]
    common = np.where(same.all(axis=1), size, same.argmin(axis=1))
    common = np.minimum(common, np.minimum(rights[order[1:]], rights[order[:-1]]))
    del right, same
    place = np.empty(count, dtype=np.int64)
    place[order] = np.arange(count)
    least = _range_minima(common) if count > 1 else None
    nearest = middle - high
    group = np.zeros(count, dtype=np.int64)  # equal bytes between the start and the anchor
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for distance in range(int(to_anchor.max(initial=0)) + 1):
        valid = nearest[order] <= distance
        v, g = order[valid], group[valid]
        match = np.flatnonzero(g[1:] == g[:-1])
        if len(match):
            match = match[least(place[v[match]], place[v[match + 1]]) >= size - distance]
        if len(match):
            common_here = np.zeros(len(v) - 1, dtype=np.int64)
            common_here[match] = size
            previous, following = nearer_positions(rank[v], common_here, size)
            repeated = np.zeros(len(v), dtype=bool)  # rows that repeat a key hold one position several times
            repeated[match] = repeated[match + 1] = True
            repeated |= (previous == size) | (following == size)
            later = previous[repeated] == size
            v = v[repeated]
            found.append((v, middle[v] - distance, later))
        more = to_anchor[order] > distance
        order, group = order[more], group[more]
        if not len(order):
            break
        byte = raw[begins[order] + to_anchor[order] - distance - 1]
        turn = np.argsort(byte, kind="stable")
        order, byte, group = order[turn], byte[turn], group[turn]
        group = np.concatenate([[0], np.cumsum((byte[1:] != byte[:-1]) | (group[1:] != group[:-1]))])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Segments:
    """The segments that one partition gets, matched in batches that keep an anchor together."""

    def __init__(self):
        self.rows: list[tuple] = []

    def answers(self, size: int, keep_first: bool, parts: int) -> Iterator[dict[str, list]]:
        if not self.rows:
            return
        anchor = np.array([r[0] for r in self.rows], dtype=np.int64)
        order = np.argsort(anchor, kind="stable")
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(anchor[order])) + 1, [len(order)]])
        low = 0
        while low < len(order):
            high = int(bounds[np.searchsorted(bounds, low + BATCH_SEGMENTS, side="right") - 1])
            if high <= low:
                high = int(bounds[np.searchsorted(bounds, low, side="right")])
            yield from self._matched([self.rows[i] for i in order[low:high].tolist()], size, keep_first, parts)
            low = high

    @staticmethod
    def _matched(rows: list[tuple], size: int, keep_first: bool, parts: int) -> Iterator[dict[str, list]]:
        _, k1, k2, low, high, middle, content = zip(*rows, strict=True)
        k1, k2 = np.array(k1, dtype=np.int64), np.array(k2, dtype=np.int64)
        low, high, middle = (np.array(x, dtype=np.int64) for x in (low, high, middle))
        lengths = np.array(list(map(len, content)), dtype=np.int64)
        raw = np.frombuffer(b"".join(content), np.uint8)
        rank = np.empty(len(rows), dtype=np.int64)
        order = np.lexsort((middle, k2, k1))
        steps = np.any([np.diff(x[order]) != 0 for x in (k1, k2, middle)], axis=0)
        rank[order] = np.concatenate([[0], np.cumsum(steps)])  # rows that repeat a key share their ranks
        segment, start, later = repeated_starts(raw, np.cumsum(lengths) - lengths, low, high, middle, rank, size)
        if keep_first:
            segment, start = segment[later], start[later]
        if not len(segment):
            return
        _, first, doc = np.unique(np.stack([k1, k2]), axis=1, return_index=True, return_inverse=True)
        doc = doc.reshape(-1)[segment]
        turn = np.lexsort((start, doc))
        yield answer_rows(k1[first], k2[first], *span_pairs(doc[turn], start[turn]), parts)


def _segment_batches(done: list, hot: np.ndarray, parts: int, size: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Segments to send, equal ones once; the strings around hot anchors as items."""
    schema = arrow_schema(_SEGMENT_SCHEMA)
    chunk = Chunk(parts, schema, keep_first)
    groups: dict[tuple, list[tuple]] = {}
    anchors = np.fromiter((row[0] for row in done), dtype=np.int64, count=len(done))
    at = np.minimum(np.searchsorted(hot, anchors), max(len(hot) - 1, 0))
    is_hot = (hot[at] == anchors).tolist() if len(hot) else [False] * len(done)
    for (anchor, k1, k2, low, high, middle, content), frequent in zip(done, is_hot, strict=True):
        if frequent:
            piece = np.frombuffer(content, np.uint8)
            place = np.arange(low, high + 1)
            chunk.add(np.array([k1]), np.array([k2]), np.zeros(len(place), np.int64), place, _hashes(piece, size))
            if chunk.items >= CHUNK_ITEMS:
                yield from chunk.flush()
        else:
            groups.setdefault((anchor, high - low, middle - low, content), []).append((k1, k2, low, high, middle))
    yield from chunk.flush()
    sent: dict[str, list] = {x: [] for x in ("part", "k1", "k2", "anchor", "low", "high", "middle", "bytes")}
    copies: list[tuple[int, int, int, int]] = []
    for (anchor, _, _, content), members in groups.items():
        members.sort()
        k1, k2, low, high, middle = members[0]
        values = (int(np.uint64(anchor & (2**64 - 1)) >> np.uint64(32)) * parts >> 32, k1, k2, anchor, low, high, middle, content)
        for column, value in zip(sent.values(), values, strict=True):
            column.append(value)
        if len(members) > 1:
            copies.extend(x[:4] for x in members if not (keep_first and x == members[0]))
    if sent["part"]:
        yield batch_of(sent, schema)
    if copies:
        k1, k2, low, high = (np.array(x, dtype=np.int64) for x in zip(*sorted(copies), strict=True))
        doc = np.concatenate([[0], np.cumsum((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))])
        first = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])
        yield batch_of(answer_rows(k1[first], k2[first], doc, low, high + 1, parts), schema)


def remove_repeated_bytes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = MATCH_BYTES,
    keep: str = "none",
    anchor: int = ANCHOR_BYTES,
    hot_least: int = HOT_LEAST,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans (array of byte ranges), kept (binary).

    A byte goes if a string of `size` bytes over it starts anywhere else too, in the same document or
    another. With keep="none" all copies go; with keep="first" the copy that is first in key order stays,
    however frequent it is. Matches never cross documents and are judged on the input. NULL text is empty;
    texts shorter than `size` lose nothing; rows that repeat an id and a text are copies of each other with
    keep="none", and are treated alike with keep="first". An empty table gives an empty result.
    """
    rows = keyed(documents, id_column, text_column)
    parts = partitions(documents.sparkSession)
    keep_first = keep == "first"

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(parts, arrow_schema(ENTRY_SCHEMA))
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_bytes(batch.column(2))
            for first, past, shift, piece, bounds in _pieces(data, offsets, size):
                row, low, _, _, hashes = anchor_runs(piece, bounds, size, anchor)
                chunk.add(k1[first:past], k2[first:past], row, low + shift, hashes)
                if chunk.items >= CHUNK_ITEMS:
                    yield from chunk.flush()
        yield from chunk.flush()

    entries = rows.select("k1", "k2", "text").mapInArrow(collect, ENTRY_SCHEMA)
    anchors = stored(answers(entries, parts, hot_least), "anchors")
    items = anchors.filter("keys is null and hot is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # At most HOT_SHARE numbers, as each stands for more than that share of all items.
    frequent = anchors.filter((F.col("hot").isNotNull()) & (F.col("n") >= max(hot_least, items // HOT_SHARE)))
    hot = np.array(sorted(r.hot for r in frequent.select("hot").collect()), dtype=np.int64)

    def segments(doc_id, text: bytes, key, begins: np.ndarray, ends: np.ndarray) -> list[tuple]:
        if not len(begins):
            return []
        wanted = set()
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            wanted.update(range(a, b))
        data = np.frombuffer(text, np.uint8)
        out = []
        for _, _, shift, piece, bounds in _pieces(data, np.array([0, len(data)]), size):
            _, low, high, middle, hashes = anchor_runs(piece, bounds, size, anchor)
            for a, b, m, h in zip(low.tolist(), high.tolist(), middle.tolist(), hashes.view(np.int64).tolist(), strict=True):
                if a + shift in wanted:
                    a, b, m = a + shift, b + shift, m + shift
                    out.append((h, *key, a, b, m, text[a : b + size]))
        return out

    def send(done: list) -> Iterator[pa.RecordBatch]:
        yield from _segment_batches(done, hot, parts, size, keep_first)

    sent = with_answers(rows, anchors, parts, segments, _SEGMENT_SCHEMA, send, 8_000_000)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_ANSWER)
        gathered, mine = Entries(), Segments()
        for batch in batches:
            for r in batch.to_pylist():
                if r["bytes"] is not None:
                    mine.rows.append((r["anchor"], r["k1"], r["k2"], r["low"], r["high"], r["middle"], r["bytes"]))
                elif r["hashes"] is not None:
                    gathered.add(r["hashes"], r["keys"], r["places"], r["again"], r["again_counts"])
                else:
                    yield batch_of({name: [r[name]] for name in schema.names}, schema)
        for out in chain(gathered.answers(parts, keep_first=keep_first), mine.answers(size, keep_first, parts)):
            yield batch_of(out, schema)

    found = stored(sent.repartitionById(parts, F.col("part")).mapInArrow(match, _ANSWER), "repeated-bytes")
    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)

    def finish(doc_id, text: bytes, key, begins: np.ndarray, ends: np.ndarray) -> list[tuple]:
        if not len(begins):
            return [(doc_id, len(text), 0, [], text)]
        steps = np.zeros(len(text) + 1, dtype=np.int32)
        np.add.at(steps, begins, 1)
        np.add.at(steps, np.minimum(ends - 1 + size, len(text)), -1)
        gone = np.cumsum(steps[:-1]) > 0
        spans = [{"begin": int(a), "end": int(b)} for a, b in zip(*runs(gone), strict=True)]
        return [(doc_id, len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes())]

    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def make(done: list) -> Iterator[pa.RecordBatch]:
        doc_id, n_bytes, n_removed, spans, kept = zip(*done, strict=True)
        arrays = [
            pa.array(doc_id, id_arrow),
            pa.array(n_bytes, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array(spans, span_type),
            pa.array(kept, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
    return with_answers(rows, found, parts, finish, schema, make)

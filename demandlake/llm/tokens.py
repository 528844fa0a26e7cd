"""Token ids of many whole texts at once, each different word piece encoded once.

The tokenizer's pieces never reach across white space, nor does its normalizer, so a text's ids are the ids
of its words, one after the other. Words of plain letters and plain punctuation are cut further, where the
pre-tokenizer always cuts: between the two. All other words go to the tokenizer as they are. The different
units of a slice are found by 64-bit hash, and those not met before are encoded together in one call.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import public_tokenizers

from demandlake.llm.words import _BYTE_BASE, mixed, prefix_sums, range_hashes

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHED_UNITS = 3_000_000

_SPACE, _LETTER, _MARK, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[list(b".,!?;:|#$%&*")] = _MARK
# Second bytes of Latin-1 letters after lead byte C3, and those of capitals, which end 32 below the small ones.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[[b for b in range(0x80, 0x9F) if b != 0x97]] = True


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return tokenizer(path).get_vocab_size(with_added_tokens=True)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes to encode (small letters in plain words), unit starts and ends, and which units are plain."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = _LETTER
    shift = ((data >= 65) & (data <= 90)).astype(np.uint8)
    shift[lead + 1] = _CAPITAL[data[lead + 1]]
    inside = kind != _SPACE
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] |= inside[cuts]
    word = np.cumsum(begins, dtype=np.int32) - 1
    odd_words = np.zeros(int(word[-1]) + 2 if len(word) else 1, dtype=bool)
    odd_words[word[kind == _OTHER]] = True
    odd = odd_words[word] & inside
    shift[odd] = 0
    changes = np.zeros(len(data), dtype=bool)
    changes[1:] = (kind[1:] != kind[:-1]) & ~odd[1:]
    at = np.flatnonzero(inside & (begins | changes))
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] |= inside[cuts - 1]
    last[:-1] |= inside[:-1] & changes[1:]
    return data + shift * np.uint8(32), at, np.flatnonzero(last) + 1, ~odd[at]


class Encoder:
    """Encodes texts with one tokenizer and remembers the ids of the units met so far, up to a bound."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        # The same model without the steps that plain units do not need.
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        ends = [i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith("</w>")]
        self.closes = np.zeros(vocabulary_size(path), dtype=bool)
        self.closes[ends] = True
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, sorted
        self.place = np.zeros(0, np.int64)  # of each in the lists below
        self.lengths = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode_units(self, plain: str, count: int, odd: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of `count` plain units, joined by blanks, and of the odd ones; and the number of ids of each."""
        ids = self.plain.encode_batch_fast([plain], add_special_tokens=False)[0].ids
        ids = np.array(ids, dtype=np.uint32)
        stops = np.flatnonzero(self.closes[ids]) + 1
        if len(stops) != count or (count and stops[-1] != len(ids)):
            raise ValueError("the vocabulary does not mark where words end")
        each = [x.ids for x in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
        more = np.array([i for of_unit in each for i in of_unit], dtype=np.uint32)
        counts = [np.diff(stops, prepend=0), np.array(list(map(len, each)), dtype=np.int64)]
        return np.concatenate([ids, more]), np.concatenate(counts).astype(np.int64)

    def _learn(self, hashes: np.ndarray, pieces: np.ndarray, starts, ends, plain) -> None:
        order = np.argsort(~plain, kind="stable")
        split = int(plain.sum())
        begin, size = starts[order[:split]], (ends - starts)[order[:split]] + 1
        after = np.cumsum(size)
        joined = np.append(pieces, np.uint8(32))[np.repeat(begin - (after - size), size) + np.arange(int(size.sum()))]
        joined[after - 1] = 32
        raw = pieces.tobytes()
        odd = [raw[a:b].decode() for a, b in zip(starts[order[split:]].tolist(), ends[order[split:]].tolist(), strict=True)]
        ids, counts = self._encode_units(joined.tobytes().decode(), split, odd)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = len(self.lengths) + np.arange(len(order))
        at = np.searchsorted(self.known, hashes)  # both sorted
        self.known, self.place = np.insert(self.known, at, hashes), np.insert(self.place, at, place)
        self.lengths = np.concatenate([self.lengths, counts])
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(counts) - counts])
        self.ids = np.concatenate([self.ids, ids])

    def _missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == hashes[found]
        return ~found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows between consecutive offsets, end to end, and the offsets of the rows' ids."""
        offsets = np.asarray(offsets, dtype=np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        pieces, starts, ends, plain = _units(data, offsets)
        sums = prefix_sums(pieces.astype(np.uint64) + np.uint64(1), _BYTE_BASE)
        hashes = mixed(range_hashes(sums, _BYTE_BASE, starts, ends) + (ends - starts).astype(np.uint64))
        different, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = self._missing(different)
        if new.any():
            if len(self.known) + int(new.sum()) > CACHED_UNITS:
                self._forget()
                new[:] = True
            at = first[new]
            self._learn(different[new], pieces, starts[at], ends[at], plain[at])
        place = self.place[np.searchsorted(self.known, different)][which]
        lengths, begins = self.lengths[place], self.begins[place]
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        ids = self.ids[np.repeat(begins - (after - lengths), lengths) + np.arange(total)]
        row_units = np.searchsorted(starts, offsets)
        return ids, np.concatenate([[0], after])[row_units]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept between tasks."""
    return Encoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end_id` after each row's, and the new offsets."""
    rows = len(bounds) - 1
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(rows + 1)

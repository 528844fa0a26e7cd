"""The training-data operators against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from demandlake.llm import (
    exact_dedup,
    lm_scores,
    mixing,
    packing,
    quality_model,
    quality_rules,
    queries,
    repeats,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_files,
)
from demandlake.llm.tokens import default_path, encoder, tokenizer
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, part string, keep_id int"

given = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


def _words(seed: int, count: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdéß", k=draw.randint(1, 7))) for _ in range(count)]


def _texts() -> list[str | None]:
    """Copies, near copies, shared passages, odd white space, empty and long texts."""
    passage = _words(1, 90)
    texts: list[str | None] = [None, "", " \n\t", "a", "a b", "ab " * 400]
    for i in range(30):
        body = _words(100 + i, 120)
        if i % 3 == 0:
            body[40:40] = passage[i : 60 + i]
        texts.append(" ".join(body) if i % 2 else "\n".join(body))
    near = _words(7, 400)
    for i in range(6):
        near[i * 10] = "changed"
        texts.append(" ".join(near))
    texts += [texts[8], texts[8], texts[9], " ".join(_words(5, 9000)), "Ünïcode 😀\x0b\x0cwords don't <|endoftext|> É" * 3]
    return texts


def _documents(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None, True, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return _documents(spark, _texts()).cache()


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate((t or "").encode() for t in _texts()))


def _by_id(frame):
    return {row.doc_id: row for row in frame.collect()}


def _removed(items: dict, size: int):
    """Which places of each sequence lie in a run of `size` that starts elsewhere too."""
    count = Counter(s[i : i + size] for s in items.values() for i in range(len(s) - size + 1))
    out = {}
    for key, s in items.items():
        gone = [False] * len(s)
        for i in range(len(s) - size + 1):
            if count[s[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        out[key] = gone
    return out


@pytest.mark.parametrize("content_hash", [F.md5, F.length], ids=["md5", "colliding"])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(documents, texts, content_hash, keep):
    found = _by_id(exact_dedup.exact_groups(documents, keep=keep, content_hash=content_hash))
    groups = defaultdict(list)
    for key, text in texts.items():
        groups[text].append(key)
    assert len(found) == len(texts)
    for key, text in texts.items():
        keep_id = (max if keep == "largest" else min)(groups[text])
        expected = (keep_id, len(groups[text]), key == keep_id, hashlib.sha256(text).hexdigest())
        assert tuple(found[key])[1:] == expected


def test_substrings(documents, texts, monkeypatch):
    words = {key: tuple(text.split()) for key, text in texts.items()}
    expected = _removed(words, 35)
    for items in (repeats.CHUNK_ITEMS, 300):
        monkeypatch.setattr(substring_dedup, "CHUNK_ITEMS", items)
        found = _by_id(substring_dedup.remove_repeats(documents))
        for key, gone in expected.items():
            kept = b" ".join(w for w, g in zip(words[key], gone, strict=True) if not g)
            assert (found[key].n_words, found[key].n_removed) == (len(gone), sum(gone))
            assert found[key].kept_text.encode() == kept
            assert sum(s.end - s.begin for s in found[key].spans) == sum(gone)


@pytest.mark.parametrize("hot_least", [2000, 2], ids=["suffix order", "frequent anchors"])
def test_suffix_order(documents, texts, hot_least):
    expected = _removed(texts, 120)
    found = _by_id(suffix_dedup.remove_repeated_bytes(documents, size=120, anchor=20, hot_least=hot_least))
    for key, gone in expected.items():
        kept = bytes(b for b, g in zip(texts[key], gone, strict=True) if not g)
        assert (found[key].n_bytes, found[key].n_removed, bytes(found[key].kept)) == (len(gone), sum(gone), kept)


def test_suffix_order_keeps_a_first_copy(spark):
    text = " ".join(_words(3, 60))
    found = suffix_dedup.remove_repeated_bytes(_documents(spark, [text, text, text]), size=120, anchor=20, keep="first")
    assert sorted(len(row.kept) for row in found.collect()) == [0, 0, len(text.encode())]


def test_token_files_give_back_all_ids(documents, texts):
    found = _by_id(token_files.token_files(documents))
    start = 0
    for key, text in texts.items():
        ids = [*tokenizer(default_path()).encode(text.decode(), add_special_tokens=False).ids, 1]
        assert found[key].start == start and found[key].n_tokens == len(ids)
        assert np.frombuffer(found[key].ids, "<u4").tolist() == ids
        start += len(ids)


@pytest.mark.parametrize("bits", [1, 3, 8, 15, 16, 17, 32])
def test_packed_bits(tmp_path, bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    path = str(tmp_path / "x.bin")
    with open(path, "wb") as sink:
        writer = token_files.TokenFileWriter(sink, bits, 64)
        writer.add([5, None], ids, np.array([0, 300, 1000]))
        writer.close()
    with pa.OSFile(path) as source:
        reader = token_files.TokenFileReader(source)
        assert reader.doc_ids == [5, None] and reader.ends.tolist() == [300, 1000]
        assert reader.read(130, 700).tolist() == ids[130:700].tolist()


def test_mixing_reaches_its_targets(documents, texts):
    rows = mixing.mix(documents, block_words=1).collect()
    again = mixing.mix(documents.repartition(7), block_words=1).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    source = {r.doc_id: r.source for r in documents.collect()}
    size = {key: len(text.split()) for key, text in texts.items()}
    totals = Counter()
    for key, name in source.items():
        totals[name] += size[key]
    names = sorted((x for x in totals if x is not None), key=str) + [None]
    weight = {name: 1 + i % 3 for i, name in enumerate(names)}
    target, free, left = {}, set(names), float(sum(size.values()))
    while True:  # reshare what is above, again and again
        level = left / sum(weight[x] for x in free) if free else 0
        above = {x for x in free if level * weight[x] > 3 * totals[x]}
        if not above:
            break
        target |= {x: 3.0 * totals[x] for x in above}
        left -= sum(target[x] for x in above)
        free -= above
    target |= {x: level * weight[x] for x in free}
    taken = Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == totals[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    for name in names:
        assert abs(taken[name] - target[name]) <= 2


def test_apportionment_by_highest_quotients(spark):
    votes = [random.Random(4).randint(0, 500) for _ in range(60)]
    for seats in (0, 1, 7, 45, 1000):
        frame = spark.createDataFrame([("g", i, v, seats) for i, v in enumerate(votes)], "g string, i int, votes long, seats long")
        won = {r.i: r.won for r in mixing.apportion(frame, ["g"], [F.col("i")], "votes", "seats").collect()}
        best = sorted(((v / (2 * k + 1), -i) for i, v in enumerate(votes) for k in range(seats) if v), reverse=True)
        expected = Counter(-i for _, i in best[:seats])
        assert won == {i: expected[i] for i in range(60)}


def test_packing_covers_every_id_once(documents, texts):
    pieces = packing.pack(documents, length=256).collect()
    of, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
        filled[p.sequence_id].append(p)
    for key, text in texts.items():
        ids = np.array([*tokenizer(default_path()).encode(text.decode(), add_special_tokens=False).ids, 1], "<u4").tobytes()
        parts = sorted(of[key], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in parts) == ids
        assert all(p.doc_tokens == len(ids) // 4 and p.length == len(p.ids) // 4 for p in parts)
    for sequence, parts in filled.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 256 or sequence == max(filled)


def test_hilbert_keys_visit_neighbours():
    points = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_keys(points, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _fingerprint(text: bytes) -> int:
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_links(documents, texts):
    found = _by_id(simhash.near_duplicates(documents))
    prints = {key: _fingerprint(text) for key, text in texts.items()}
    root = {key: key for key in texts}
    for _ in texts:
        for a, b in combinations(texts, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[a] = root[b] = min(root[a], root[b])
    for key in texts:
        assert found[key].fingerprint % (1 << 64) == prints[key]
        assert found[key].component_id == root[key]


def test_links_of_close_fingerprints(spark):
    draw = random.Random(2)
    values = {draw.getrandbits(64) for _ in range(20)}
    for value in list(values):
        for _ in range(10):
            value ^= (1 << draw.randrange(64)) | (1 << draw.randrange(64))
            values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    roots = simhash.connected_components(simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long")))
    groups = defaultdict(set)
    for r in roots.collect():
        groups[r.root].add(r.node)
    expected = {v: {v} for v in signed}
    for a, b in combinations(signed, 2):
        if ((a ^ b) % (1 << 64)).bit_count() <= 2 and expected[a] is not expected[b]:
            expected[a] |= expected[b]
            for v in expected[b]:
                expected[v] = expected[a]
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in expected.values() if len(g) > 1}


def test_quality_counts(documents, texts):
    found = _by_id(quality_rules.quality_rules(documents))
    for key, text in texts.items():
        words = text.split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = Counter(windows)
        marked = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(3)}
        lines = [x for x in text.split(b"\n") if x.split()]
        row = found[key]
        assert row.n_words == len(words) and row.n_repeat_words == len(marked)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == sum(text.count(c.encode()) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (len(words) < 50 or 100 * len(marked) > 50 * len(words))
        assert not (row.base_failed and row.kept)


@given
def test_quality_rules_and_model_on_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    good = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(documents).filter("not base_failed").collect()}
    assert np.mean([kept[i] for i in good if good[i] and i in kept]) > 0.97
    scores = {r.doc_id: r for r in quality_model.quality_scores(documents, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scores.items())
    held = [(scores[i].predicted, good[i]) for i in good if scores[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_counting_needs_no_context_and_softmax_no_copy():
    texts = pa.array([None, "a b c", "", "d " * 9])
    ((low, high, first, target),) = lm_scores.targets(texts)
    ((_, _, row, context, same),) = lm_scores.examples(texts)
    assert (low, high, first.tolist()) == (0, 4, [0, 0, 3, 3, 12]) and target.tolist() == same.tolist()
    assert row.tolist() == [1] * 3 + [3] * 9
    outside, (a, b, c) = lm_scores.CLASSES**2, target[:3].tolist()
    assert context[:3].tolist() == [[outside, outside, b, c], [outside, a, c, outside], [a, b, outside, outside]]
    logits = np.random.default_rng(0).standard_normal((4, 3)).astype(np.float32)
    shares = np.exp(logits) / np.exp(logits).sum(axis=0)
    assert lm_scores._softmax(logits) is logits and np.allclose(logits, shares)


def test_network_gradient_and_training(spark):
    random_state = np.random.default_rng(0)
    context = random_state.integers(0, lm_scores.CLASSES**2 + 1, (40, 4))
    target = random_state.integers(0, lm_scores.CLASSES**2, 40)
    network = lm_scores.Network()
    slope = network.gradient(context, target).values
    for at in random_state.choice(np.flatnonzero(np.abs(slope) > 0.05), 25, replace=False).tolist():
        values = []
        for step in (1e-2, -1e-2):
            moved = network.values.copy()
            moved[at] += step
            values.append(-lm_scores.Network(moved).log_probabilities(context, target).astype(float).sum())
        assert (values[0] - values[1]) / 2e-2 == pytest.approx(slope[at], rel=0.1, abs=0.03)
    order = " ".join(f"w{i % 7}" for i in range(3000))
    jumbled = " ".join(random.Random(1).choices([f"w{i}" for i in range(7)], k=300))
    rows = spark.createDataFrame([(i, order) for i in range(20)] + [(99, jumbled), (100, None)], "doc_id long, text string")
    found = _by_id(lm_scores.lm_scores(rows))
    assert found[0].score > found[99].score + 0.3
    assert found[100].score is None and found[100].n_words == 0


OPERATORS = {
    "exact": lambda d: exact_dedup.exact_groups(d),
    "mix": lambda d: mixing.mix(d),
    "substring": lambda d: substring_dedup.remove_repeats(d),
    "tokens": lambda d: token_files.token_files(d),
    "model": lambda d: quality_model.quality_scores(d, d.sparkSession.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")),
    "lm": lambda d: lm_scores.lm_scores(d),
    "packing": lambda d: packing.pack(d),
    "simhash": lambda d: simhash.near_duplicates(d),
    "rules": lambda d: quality_rules.quality_rules(d),
    "suffix": lambda d: suffix_dedup.remove_repeated_bytes(d),
} | {f"stage {name}": (lambda stage: lambda d: stage(d.sparkSession, d, ""))(stage) for name, stage in corpus_pipeline.STAGES}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows(spark, name):
    """NULLs in every column, repeated rows, and no rows at all."""
    text = " ".join(_words(9, 80))
    rows = [(None,) * 8, (None, text, None, None, None, None, None, None), (1, text, "en", "s", 5, None, "p", 3)]
    rows += [(1, text, "en", "s", 5, None, "p", 3), (1, "other", "en", None, 5, True, None, None), (2, "", "", "", 0, False, "", 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = OPERATORS[name](frame)
    count = found.count()
    if name.startswith("stage"):
        if not name.endswith("packing"):
            assert found.columns == corpus_pipeline.DOCUMENT_COLUMNS
    else:
        assert count >= len(rows) and set(found.columns) & {"doc_id"}
    empty = OPERATORS[name](frame.limit(0))
    assert empty.count() == 0 and empty.columns == found.columns


@given
@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), SF_DIR, queries.ORACLES[name]) == []


def test_encoder_forgets_and_stays_right(monkeypatch):
    from demandlake.llm import tokens

    monkeypatch.setattr(tokens, "CACHED_UNITS", 50)
    own = tokens.Encoder(default_path())
    for seed in range(5):
        text = " ".join(_words(seed, 40)).encode()
        ids, _ = own.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == tokenizer(default_path()).encode(text.decode(), add_special_tokens=False).ids
    assert encoder(default_path()) is encoder(default_path())


def test_first_copies_stay_however_frequent(spark):
    passage = " ".join(_words(3, 60))
    texts = [passage, passage, passage] + [" ".join([*_words(i, 40), passage, *_words(50 + i, 30)]) for i in range(20)]
    frame = _documents(spark, texts).repartition(6)
    kept = []
    for hot_least in (2, 10**9):
        found = suffix_dedup.remove_repeated_bytes(frame, size=120, anchor=20, keep="first", hot_least=hot_least)
        kept.append({row.doc_id: bytes(row.kept) for row in found.collect()})
    assert kept[0] == kept[1]
    assert sum(passage.encode() in text for text in kept[0].values()) == 1
    twice = spark.createDataFrame([(1, passage), (1, passage)], "doc_id long, text string")
    for hot_least in (2, 10**9):
        found = suffix_dedup.remove_repeated_bytes(twice, size=120, anchor=20, keep="first", hot_least=hot_least)
        assert {bytes(row.kept) for row in found.collect()} == {passage.encode()}


def _row_of_words(seed: int, symbols: int) -> str:
    words = _words(seed, 100)
    return " ".join(words[symbols:] + [w + "#" for w in words[:symbols]])


def test_junk_and_copies_set_no_limit(spark):
    """A third of the texts of a source, and a page copied over another source, are full of symbols."""
    rows = [(i, _row_of_words(i, 30 if i % 3 == 0 else i % 2), "en", "a") for i in range(600)]
    rows += [(i, _row_of_words(i, 0), "en", "b") for i in range(600, 900)]
    rows += [(i, _row_of_words(7777, 90), "en", "b") for i in range(900, 1200)]
    rows += [(i, "# # # #", "en", "b") for i in range(1200, 1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.quality_rules(frame).filter("kept").collect()}
    good = {i for i in range(600) if i % 3} | set(range(600, 900))
    assert kept == good

"""Every stage of the pipeline, and all of it, against brute force on the whole of a small table."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
import xxhash

import corpus_pipeline
from demandlake.llm import quality_rules
from demandlake.llm.frames import DOCUMENT_COLUMNS, read
from demandlake.llm.tokens import default_path, tokenizer

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def _rows(frame):
    return [tuple(row) for row in frame.select(*DOCUMENT_COLUMNS).collect()]


def _text(row):
    return row[1] or ""


# --- Quality rules, row by row ------------------------------------------------------------------


def _counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    threes = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = set()
    for i in range(len(words) - 2):
        if threes[tuple(words[i : i + 3])] > 1:
            repeated.update((i, i + 1, i + 2))
    capitals = sum("A" <= c <= "Z" or ("\xc0" <= c <= "\xde" and c != "\xd7") for c in text)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_upper": capitals,
    }


def _bin(value):
    spare = max(value.bit_length() - 7, 0)
    return value >> spare << spare


def _quartiles(weights):
    total, reached, out = sum(weights.values()), 0, []
    for value in sorted(weights):
        reached += weights[value]
        while len(out) < 3 and 4 * reached >= (len(out) + 1) * total:
            out.append(value)
    return out


def _kept_by_rules(rows):
    counts = [_counts(_text(row)) for row in rows]
    failed = [c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for c in counts]
    own, common = defaultdict(Counter), defaultdict(Counter)
    seen_own, seen_common = set(), set()
    for row, c, bad in zip(rows, counts, failed, strict=True):
        if bad:
            continue
        for rule, (top, bottom, _) in quality_rules.RULES.items():
            if c[bottom]:
                value = _bin(1000 * c[top] // c[bottom])
                if (row[2], row[3], _text(row), rule) not in seen_own:
                    seen_own.add((row[2], row[3], _text(row), rule))
                    own[row[2], row[3], rule][value] += 1
                if (row[2], _text(row), rule) not in seen_common:
                    seen_common.add((row[2], _text(row), rule))
                    common[row[2], rule][value] += 1
    limits = {}
    for (lang, source, rule), bins in own.items():
        of_language = common[lang, rule]
        total = sum(of_language.values())
        both = Counter({v: n * total for v, n in bins.items()})
        for v, n in of_language.items():
            both[v] += n * quality_rules.COMMON_TEXTS
        (q1, _, q3), (c1, c2, c3) = _quartiles(both), _quartiles(of_language)
        slack = quality_rules.RULES[rule][2]
        reach = max(quality_rules.SPREADS * (q3 - q1), slack)
        bound = max(2 * quality_rules.SPREADS * min(c3 - c2, c2 - c1), slack)
        limits[lang, source, rule] = (max(q1 - reach, c2 - bound), min(q3 + reach, c2 + bound))
    verdicts = []
    for row, c, bad in zip(rows, counts, failed, strict=True):
        good = not bad
        for rule, (top, bottom, _) in quality_rules.RULES.items():
            if good and c[bottom] and (row[2], row[3], rule) in limits:
                least, most = limits[row[2], row[3], rule]
                value = 1000 * c[top] // c[bottom]
                good = value <= most and (value >= least or rule not in quality_rules.LOWER_TOO)
        verdicts.append(good)
    return verdicts


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_rules_keep_what_brute_force_keeps(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = _rows(docs)
    expected = [row for row, good in zip(rows, _kept_by_rules(rows), strict=True) if good]
    assert sorted(map(str, _rows(STAGES["quality_rules"](spark, docs, sf_dir)))) == sorted(map(str, expected))
    found = quality_rules.quality_rules(docs).collect()
    assert {r.doc_id for r in found if r.kept} == {row[0] for row in expected}
    assert 0 < len(expected) < len(rows)


def test_a_source_has_its_own_limit_without_a_step_in_size(spark):
    """One more text in a source moves its limits by little, at any size."""
    def limits_with(count):
        rows = [(i, "en", "a", i % 30) for i in range(300)] + [(1000 + i, "en", "b", 100 + i % 20) for i in range(count)]
        frame = spark.createDataFrame(
            [(lang, source, i, 1000, 5000, symbols, 0, 0, 10, 0) for i, lang, source, symbols in rows],
            "lang string, source string, text_hash long, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS),
        )
        return {r.source: r.most_symbols for r in quality_rules.limits(frame).collect()}["b"]

    found = [limits_with(count) for count in (1, 99, 100, 101, 3000)]
    assert found == sorted(found) and found[0] < found[-1]
    assert found[1] == pytest.approx(found[2], rel=0.1) and found[2] == pytest.approx(found[3], rel=0.1)


# --- The other stages ---------------------------------------------------------------------------


def _without_copies(rows):
    best = {}
    for row in rows:
        key = _text(row)
        if key not in best or (row[0] is not None and (best[key][0] is None or row[0] > best[key][0])):
            best[key] = row
    return list(best.values())


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _one_of_each_component(rows):
    prints = [_fingerprint(_text(row)) for row in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[find(i)].append(row)
    return [min(group, key=lambda row: (row[0] is None, row[0] or 0)) for group in groups.values()]


def test_copies_and_near_copies(spark):
    docs = read(spark, SF_DIR, "documents")
    rows = _rows(docs)
    expected = _without_copies(rows)
    found = STAGES["exact_dedup"](spark, docs, SF_DIR)
    assert sorted(map(str, _rows(found))) == sorted(map(str, expected))
    expected = _one_of_each_component(expected)
    found = STAGES["simhash_near_dedup"](spark, found, SF_DIR)
    assert sorted(map(str, _rows(found))) == sorted(map(str, expected))
    assert len(expected) < len(rows)


@pytest.mark.parametrize("name", ["exact_dedup", "simhash_near_dedup"])
def test_rows_that_repeat_stay_once(spark, name):
    """Of copies one row stays, also of rows that repeat both id and text, whatever their other columns say."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(5, words, "en", "a", 1)] * 4 + [(5, words, None, "b", None), (3, words, "de", "c", 2), (None, words, "x", "y", 3)]
    rows += [(None, "alone among the nameless", None, None, None)] * 3 + [(9, None, "en", "a", 0), (9, "", "en", "a", 0)]
    rows += [(7, "same id", "en", "a", 1), (7, "with other words altogether", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = _rows(STAGES[name](spark, docs, ""))
    assert Counter((row[0], _text(row)) for row in kept) == Counter(
        {
            (5 if name == "exact_dedup" else 3, words): 1,
            (None, "alone among the nameless"): 1,
            (9, ""): 1,
            (7, "same id"): 1,
            (7, "with other words altogether"): 1,
        }
    )


def test_mixing_takes_each_source_to_its_target(spark):
    docs = read(spark, SF_DIR, "documents")
    rows = _rows(docs)
    size = {row[0]: len(_counts_words(_text(row))) for row in rows}
    source = {row[0]: row[3] for row in rows}
    total = Counter()
    for doc_id, name in source.items():
        total[name] += size[doc_id]
    order = sorted(total, key=lambda name: (name is None, name or ""))
    weight = {name: i % 3 + 1 for i, name in enumerate(order)}
    free, targets = set(order), {}
    while True:
        level = (sum(total.values()) - sum(targets.values())) / sum(weight[n] for n in free) if free else 0
        full = [n for n in free if level * weight[n] > 3 * total[n]]
        if not full:
            break
        for n in full:
            targets[n] = 3 * total[n]
            free.remove(n)
    targets |= {n: level * weight[n] for n in free}
    taken, repeats = Counter(), Counter()
    texts = {row[0]: _counts_words(_text(row)) for row in rows}
    for row in _rows(STAGES["mixing"](spark, docs, SF_DIR)):
        words = _counts_words(_text(row))
        assert words == texts[row[0]][: len(words)]
        taken[row[3]] += len(words)
        repeats[row[0]] += len(words)
    for name in order:
        assert abs(taken[name] - targets[name]) <= 64
    assert all(n <= 3 * size[doc_id] for doc_id, n in repeats.items())


def _counts_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def _check_packed(found, texts):
    """Pieces cover the ids of every copy of a text exactly, in sequences without gaps and of at most 2,048 ids."""
    encode = tokenizer(default_path()).encode
    ids = {key: len(encode(text, add_special_tokens=False).ids) + 1 for key, text in texts.items()}
    sequences = defaultdict(list)
    covered = Counter()
    for piece in found:
        sequences[piece.sequence_id].append((piece.offset, piece.length))
        covered[piece.doc_id] += piece.length
        assert 0 <= piece.start and piece.start + piece.length <= piece.doc_tokens
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= 2048
    return covered, ids, len(sequences)


def test_packing_covers_every_id_once(spark):
    docs = read(spark, SF_DIR, "documents")
    found = STAGES["packing"](spark, docs, SF_DIR).collect()
    covered, ids, sequences = _check_packed(found, {row[0]: _text(row) for row in _rows(docs)})
    assert covered == ids
    assert sequences <= sum(ids.values()) // 2048 + 12


def test_run_is_its_stages_one_after_the_other(spark):
    rows = _rows(read(spark, SF_DIR, "documents"))
    rows = [row for row, good in zip(rows, _kept_by_rules(rows), strict=True) if good]
    rows = _one_of_each_component(_without_copies(rows))
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {piece.doc_id for piece in found} <= {row[0] for row in rows}
    sizes = {row[0]: len(_counts_words(_text(row))) for row in rows}
    whole = Counter()
    encode = tokenizer(default_path()).encode
    ids = {row[0]: len(encode(_text(row), add_special_tokens=False).ids) + 1 for row in rows}
    for piece in found:
        whole[piece.doc_id] += piece.length
    # The mix gives back as many words as came in, though of other documents; no document more than three times.
    assert all(n <= 3 * ids[doc_id] + 3 for doc_id, n in whole.items())
    assert sum(whole.values()) > 0 and sum(sizes.values()) > 0

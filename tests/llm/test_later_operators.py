"""Conversation repair, sharding and hard negatives against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given as any_of
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlake.llm import conversation_repair as repair
from demandlake.llm import hard_negatives as hard
from demandlake.llm import queries, sharding
from demandlake.llm.frames import read

SF_DIR = "/root/testdata/sf0.01"

# --- Conversations ------------------------------------------------------------------------------


def _damaged(rows):
    """The contract's damage, row by row."""
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        rule = zlib.crc32(key.encode()) % 20
        if rule == 1:
            text = ""
        elif rule == 2:
            text = re.sub("[.!?]", "", text)
        elif rule == 4:
            role = "user"
        yield from [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(rule, 1)


def _best_edits(rows):
    """(cost, audit, roles and texts) by trying everything: forward, one row at a time, the least by cost and text."""
    start = {"": (0, "", [])}

    def complete(states):
        # At most one round of inserts may help.
        for _ in range(4):
            for shape, (cost, audit, out) in list(states.items()):
                role = "user" if shape in ("", "s", "a") else "assistant"
                new = (cost + 3, audit + "I", out + [f"{role}:"])
                if role[0] not in states or new[:2] < states[role[0]][:2]:
                    states[role[0]] = new
        return states

    states = start
    for role, text, fault in rows:
        following = {}

        def put(shape, value):
            if shape not in following or value[:2] < following[shape][:2]:
                following[shape] = value

        for shape, (cost, audit, out) in complete(dict(states)).items():
            put(shape, (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[shape]
            if role[:1] and role[:1] in legal:
                put(role[:1], (cost + more, audit + "K", out + [f"{role}:{text}"]))
            led = "assistant" if shape == "u" else "user"
            put(led[0], (cost + more + 3, audit + "R", out + [f"{led}:{text}"]))
        states = following
    done = [value for shape, value in complete(dict(states)).items() if shape in ("", "a")]
    return min(done, key=lambda value: value[:2])


def _repaired(rows):
    """Brute force of the whole operator on damaged rows."""
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        groups[conv_id].append((turn, role, text))
    out = {}
    for conv_id, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, marked, counts = set(), [], Counter()
        for _, role, text in found:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (
                "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            )
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        initials = [r[1][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {r[0] for r in found} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = _best_edits(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest, lines)
    return out


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), [])


def _rows_of(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


def _compare(found, expected, ids):
    assert sorted(found, key=str) == sorted(ids, key=str)
    for conv_id, row in found.items():
        assert tuple(row)[1:] == expected.get(conv_id, EMPTY)[:8], conv_id


def test_repair_query_is_brute_force_on_the_whole_table(spark):
    given = read(spark, SF_DIR, "conversations")
    rows = _rows_of(given)
    found = {r.conv_id: r for r in queries.QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()}
    _compare(found, _repaired(_damaged(rows)), {r[0] for r in rows})


SCHEMA = "conv_id long, turn long, role string, text string, digest string, part int, copies int, kind string"


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 9, "y") for r in rows], SCHEMA)


def _odd_rows():
    draw = random.Random(3)
    texts = ["Yes.", "no", " \n", "", "Why?", "Ünï 😀!", "long " * 3000 + ".", None, ". x \x0b", "tail.\n"]
    roles = ["user", "assistant", "system", "", None, "ubot", "tool", "User"]
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(draw.randint(1, 14)):
            rows.append((conv, draw.choice([None, *range(-2, 9)]), draw.choice(roles), draw.choice(texts)))
    rows += [(77, None, "user", "a")] * 3 + [(78, t, "user", "Same.") for t in range(700)]
    rows += [(79, t, ["user", "assistant"][t % 2], f"text {t}.") for t in range(900)]
    return rows


@pytest.mark.parametrize("parts", [1, 40])
def test_repair_of_odd_rows(spark, parts):
    """Ties, NULLs, repeated rows, clashing columns, and conversations cut into many pieces."""
    rows = _odd_rows()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = repair.damage(_conversations(spark, rows))
        found = {r.conv_id: r for r in repair.repairs(frame).collect()}
        expected = _repaired(_damaged(rows))
        _compare(found, expected, {r[0] for r in rows})
        turns = defaultdict(list)
        for r in repair.repaired_turns(frame).orderBy("conv_id", "place").collect():
            turns[r.conv_id].append(f"{r.role}:{r.text}")
        assert {k: v for k, v in turns.items() if v} == {k: v[8] for k, v in expected.items() if v[8]}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repair_of_nothing(spark):
    nothing = _conversations(spark, [])
    assert repair.repairs(repair.damage(nothing)).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.repairs(repair.damage(_conversations(spark, [(dropped, 0, "user", "a.")]))).first()
    assert tuple(row)[1:] == EMPTY[:8]


@settings(max_examples=60, deadline=None)
@any_of(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 200)), min_size=1, max_size=6))
def test_runs_are_rows(runs):
    """Binary powers and halved runs give what one row after the other gives."""
    runs = tuple((s, n) for i, (s, n) in enumerate(runs) if i == 0 or runs[i - 1][0] != s)
    rows = [(("system", "user", "assistant", "tool")[s // 2], "x", "truncated" if s % 2 else "") if s < 8 else ("user", "", "blank")
            for s, n in runs for _ in range(n)]
    cost, audit, _ = _best_edits(rows)
    edits, state = repair.unroll(runs, repair.final_costs(), 0)
    while state not in (0, 3):
        edits, state = edits + "I", repair._NEXT[state]
    assert edits == audit
    assert min(c + f for c, f in zip(repair.runs_matrix(runs)[0], repair.final_costs(), strict=True)) == cost


# --- Shards -------------------------------------------------------------------------------------

DOCUMENTS = "doc_id long, text string, content string, block int, n long, shard string, place int"


def _documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], DOCUMENTS)


def _check_shards(found, rows, shards):
    expected = Counter()
    for doc_id, text in rows:
        raw = (text or "").encode()
        expected[doc_id, len(raw) + 1, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1


def _cut(found):
    """Groups in more than one shard: sizes, with the shards they lie in."""
    where = defaultdict(Counter)
    for r in found:
        where[r.text_crc32][r.shard] += 1
    return [(sum(w.values()), len(w)) for w in where.values() if len(w) > 1]


def test_shards_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_sharding"](spark, SF_DIR).collect()
    _check_shards(found, rows, 16)
    assert _cut(found) == []  # every group is smaller than a shard, and there is room


@pytest.mark.parametrize("block_rows", [sharding.BLOCK_ROWS, 7])
def test_shards_with_hot_groups_and_odd_rows(spark, monkeypatch, block_rows):
    """A third of all rows in one group, a repeated row, NULLs, empty and long texts, clashing columns."""
    monkeypatch.setattr(sharding, "BLOCK_ROWS", block_rows)
    rows = [(i, "hot") for i in range(400)] + [(None, None), (None, ""), (5, "hot"), (3, "é" * 100_000)]
    rows += [(7, "again")] * 90 + [(None, "nobody")] * 5
    rows += [(1000 + i, f"group {i // 4}") for i in range(240)] + [(5000 + i, f"single {i}") for i in range(460)]
    for shards in (16, 5):
        found = sharding.sharded(_documents(spark, rows), shards=shards).collect()
        _check_shards(found, rows, shards)
        cut = _cut(found)
        # The hot group fills few shards beyond those it needs; few others are cut.
        room = len(rows) // shards
        assert [parts for size, parts in cut if size > 300][0] <= 2 * math.ceil(401 / room)
        assert len(cut) <= 1 + shards // 2


def test_shards_without_room(spark):
    """Every document has a copy: only exchanges can bring pairs together."""
    rows = [(i, f"pair {i // 2}") for i in range(640)]
    found = sharding.sharded(_documents(spark, rows)).collect()
    _check_shards(found, rows, 16)
    assert len(_cut(found)) <= 40
    none = sharding.sharded(_documents(spark, rows), most_rounds=0).collect()
    _check_shards(none, rows, 16)
    assert len(_cut(none)) == 320


@pytest.mark.parametrize("count", [0, 1, 5])
def test_shards_of_few_rows(spark, count):
    rows = [(i, "same" if i < 2 else None) for i in range(count)]
    found = sharding.sharded(_documents(spark, rows)).collect()
    assert len(found) == count
    if count:
        _check_shards(found, rows, 16)


def test_sharding_is_native(spark):
    found = queries.QUERIES["op12_sharding"](spark, SF_DIR)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    again = queries.QUERIES["op12_sharding"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


# --- Hard negatives -----------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@any_of(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(0, 1000))
def test_strassen_is_the_product(m, k, n, seed):
    draw = np.random.default_rng(seed)
    a, b = draw.integers(-(2**29), 2**29, (m, k)), draw.integers(-(2**29), 2**29, (k, n))
    assert np.array_equal(hard.strassen(a, b, leaf=3), a @ b)


def _negatives(rows):
    """Brute force of the contract."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * float(x)) for x in vector], label))
    out = []
    for anchor in (r for r in kept if r[0] is not None and r[0] % 50 == 0):
        scored = [(sum(a * b for a, b in zip(anchor[1], r[1], strict=False)), r[0], r[2]) for r in kept if r[0] != anchor[0]]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for positive, positive_id, _ in [s for s in scored if s[2] == anchor[2]][:5]:
            fits = [s for s in scored if s[2] != anchor[2] and 50 * positive <= 100 * s[0] <= 95 * positive][:3]
            out += [(anchor[0], positive_id, i + 1, s[1], positive, s[0]) for i, s in enumerate(fits)]
    return sorted(out, key=str)


def test_negatives_of_the_whole_table(spark):
    rows = [tuple(r) for r in read(spark, SF_DIR, "embeddings").select("vec_id", "embedding", "label").collect()]
    found = queries.QUERIES["op13_hard_negatives"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found), key=str) == _negatives(rows) != []


@pytest.mark.parametrize(("tile_anchors", "tile_rows"), [(4096, 4096), (3, 17)])
def test_negatives_of_odd_rows(spark, tile_anchors, tile_rows):
    """NULLs anywhere, ties, repeated rows, vectors of different length, one label for most rows, clashing columns."""
    draw = random.Random(5)
    rows = []
    for i in range(400):
        vector = [draw.choice([0.0, 0.25, 0.5, -0.25, 1.0]) for _ in range(draw.choice([4, 4, 4, 3, 0]))]
        rows.append((i, vector, draw.choice([0, 0, 0, 1, 2, 9])))
    rows += [rows[50], rows[7], (None, [1.0, 1.0, 1.0, 1.0], 1), (None, [1.0] * 4, 0), (900, None, 1), (901, [1.0] * 4, None)]
    rows += [(950, [1.0, None, 1.0, 1.0], 1), (1000, [float("nan")] * 4, 1), (1001, [float("inf")] * 4, 1), (1050, [1.0, 0.5], 77)]
    frame = spark.createDataFrame(
        [(*r, 1, "x", 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, uid int, score string, a long, rank int"
    )
    found = hard.hard_negatives(frame, tile_anchors=tile_anchors, tile_rows=tile_rows).collect()
    assert sorted(map(tuple, found), key=str) == _negatives(rows) != []
    assert hard.hard_negatives(frame.limit(0)).count() == 0


def test_too_large_components_are_refused(spark):
    from pyspark.errors import PythonException

    frame = spark.createDataFrame([(50, [1e30], 1), (51, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(PythonException, match="64 bits"):
        hard.hard_negatives(frame).count()
    assert frame.filter(F.col("vec_id") == 51).count() == 1

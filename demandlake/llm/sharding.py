"""Sharding by balanced label propagation, in DataFrame functions only.

Documents of equal text are linked. Copies are interchangeable, so the labels of a group are kept as one row:
how many of its documents each shard holds. In a round every group looks at its documents' labels, its
documents ask to move to the shard that holds most of their neighbours, and quotas grant as much as shards
can take: what two shards exchange with each other, and what room one has left. Documents without a link
have no label to follow and fill the shards up to their capacity, so row counts differ by at most one
whenever the rounds end.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.frames import picked, stored, whole_text

SHARDS = 16
LAW = "rows"
MOST_ROUNDS = 12
# Rounds end when one moves no more than this part of the linked documents.
SETTLED = 0.002
# Rows of a block at least. Numbering a group looks at a block, and at its blocks: both grow with the root of it.
BLOCK_ROWS = 1_000


def _blocks(rows: int) -> int:
    return rows // max(BLOCK_ROWS, math.isqrt(rows)) + 1


def _blocks_of(rows: Column) -> Column:
    return F.floor(rows / F.greatest(F.lit(BLOCK_ROWS), F.floor(F.sqrt(rows)))) + 1


def _before(rows: DataFrame, within: list[str], block: str, order: list[str], amount: str, name: str) -> DataFrame:
    """Add `name`: the sum of `amount` over the rows before, by block and then by `order`, in each group of `within`.

    A group is summed block by block, and the few block sums once more, so no task sorts a whole group.
    """
    earlier = (W.unboundedPreceding, W.currentRow - 1)
    inside = W.partitionBy(*within, block).orderBy(*order).rowsBetween(*earlier)
    over_blocks = W.partitionBy(*[f"b_{c}" for c in within]).orderBy(f"b_{block}").rowsBetween(*earlier)
    sums = rows.groupBy(*[F.col(c).alias(f"b_{c}") for c in [*within, block]]).agg(F.sum(amount).alias("block_sum"))
    starts = sums.withColumn("block_start", F.coalesce(F.sum("block_sum").over(over_blocks), F.lit(0)))
    numbered = rows.withColumn("in_block", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    met = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"b_{c}") for c in [*within, block]])
    joined = numbered.join(starts, met)
    return joined.withColumn(name, F.col("block_start") + F.col("in_block")).select(*rows.columns, name)


def _spread(key: Column, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _first_labels(groups: DataFrame, shards: int, blocks: int) -> DataFrame:
    """Deal the documents of all groups round the shards: rows (content, n, held), balanced to one row."""
    placed = _before(groups.withColumn("block", _spread(F.col("content"), blocks)), [], "block", ["content"], "n", "start")
    low, high = F.col("start"), F.col("start") + F.col("n")

    def up_to(end: Column, shard: Column) -> Column:  # how many of 0..end-1 are dealt to the shard
        return F.floor((end + (shards - 1) - shard) / shards)

    held = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: up_to(high, s) - up_to(low, s))
    return placed.select("content", "n", held.alias("held"))


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _ends(amounts: str, field: str) -> Column:
    """Of an array of structs the running sums of a field, each with the one before: (low, high, shard)."""
    sums = F.aggregate(
        F.col(amounts),
        F.array(F.lit(0).cast("long")),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x[field])),
    )
    return F.transform(
        F.col(amounts), lambda x, i: F.struct(F.get(sums, i).alias("low"), F.get(sums, i + 1).alias("high"), x["shard"].alias("shard"))
    )


def _proposals(state: DataFrame, room: list[int]) -> DataFrame:
    """What each group asks for: rows (content, s, t, amount, gain).

    A group's documents follow the shard that holds most of them, among those with room for all that are
    elsewhere. If there is none, they follow the few that hold most and have room for the rest together, as a
    group larger than a shard must; if all are full, the one that holds most, which exchanges may open.
    Equal counts are ordered by a hash, so that no shard is preferred. A group of one shard asks for nothing.
    """
    shards = F.sequence(F.lit(0), F.lit(len(room) - 1))
    has = _numbers(room)

    def rank(shard: Column) -> Column:
        return F.struct(
            F.get(F.col("held"), shard).alias("held"),
            F.xxhash64("content", shard).alias("tie"),
            shard.alias("shard"),
            F.get(has, shard).alias("room"),
        )

    # From the shard that holds most of a group downwards.
    ranked = F.reverse(F.array_sort(F.transform(shards, rank)))
    split = state.filter(F.array_max("held") < F.col("n")).select("content", "n", ranked.alias("ranked"))
    split = split.withColumns(
        {
            "fit": F.get(F.filter("ranked", lambda r: r["room"] >= F.col("n") - r["held"]), F.lit(0)),
            "open_ones": F.filter("ranked", lambda r: r["room"] > 0),
        }
    )

    def reached(i: Column) -> Column:  # whether the open shards before the i-th hold or take the whole group
        return F.aggregate(F.slice("open_ones", F.lit(1), i), F.lit(0).cast("long"), lambda a, r: a + r["held"] + r["room"])

    split = split.withColumn(
        "targets",
        F.when(F.col("fit").isNotNull(), F.array("fit"))
        .when(F.size("open_ones") == 0, F.slice("ranked", 1, 1))
        .otherwise(F.filter("open_ones", lambda r, i: reached(i) < F.col("n"))),
    )
    chosen = F.transform("targets", lambda r: r["shard"])
    split = split.withColumn("sources", F.filter("ranked", lambda r: (r["held"] > 0) & ~F.array_contains(chosen, r["shard"])))
    # One target takes every source; several are filled one after the other, along the sources.
    single = F.size("targets") == 1
    whole = F.struct(F.lit(0).cast("long").alias("low"), F.col("n").alias("high"), F.get(chosen, F.lit(0)).alias("shard"))
    laid = split.select(
        "content",
        F.get("targets", F.lit(0))["held"].alias("gain"),
        _ends("sources", "held").alias("sources"),
        F.when(single, F.array(whole)).otherwise(_ends("targets", "room")).alias("targets"),
    )
    asked = laid.select("content", "gain", "targets", F.explode("sources").alias("source"))
    asked = asked.select("content", "gain", "source", F.explode("targets").alias("target"))
    amount = F.least("source.high", "target.high") - F.greatest("source.low", "target.low")
    return asked.select(
        "content",
        F.col("source.shard").alias("s"),
        F.col("target.shard").alias("t"),
        amount.alias("amount"),
        "gain",
    ).filter("amount > 0")


def _quotas(asked: DataFrame, room: list[int]) -> DataFrame:
    """How much may move from s to t: what t gives back to s, and a share of t's room. At most shards**2 rows."""
    sums = asked.groupBy("s", "t").agg(F.sum("amount").alias("asked"))
    back = sums.select(F.col("t").alias("bs"), F.col("s").alias("bt"), F.col("asked").alias("given"))
    paired = sums.join(back, (F.col("s") == F.col("bs")) & (F.col("t") == F.col("bt")), "left")
    both = F.least("asked", F.coalesce("given", F.lit(0)))
    paired = paired.select("s", "t", "asked", both.alias("both")).withColumn("rest", F.col("asked") - F.col("both"))
    all_rest = F.sum("rest").over(W.partitionBy("t"))
    high = F.sum("rest").over(W.partitionBy("t").orderBy("s").rowsBetween(W.unboundedPreceding, W.currentRow))
    space = F.get(_numbers(room), F.col("t"))

    def given_to(end: Column) -> Column:  # shares of a room add up to the whole room
        return F.floor(end.cast("decimal(19,0)") * space / F.greatest(all_rest, F.lit(1))).cast("long")

    share = F.when(all_rest <= space, F.col("rest")).otherwise(given_to(high) - given_to(high - F.col("rest")))
    return paired.withColumn("share", share).select(
        F.col("s").alias("qs"), F.col("t").alias("qt"), (F.col("both") + F.col("share")).alias("quota")
    )


def _moved(state: DataFrame, asked: DataFrame, quotas: DataFrame, blocks: int) -> DataFrame:
    """The state after the moves that quotas grant, those with most neighbours at their target first."""
    level = F.lit(63) - F.floor(F.log2(F.col("gain") + 1)).cast("long")
    rows = asked.withColumn("block", level * blocks + _spread(F.col("content"), blocks))
    rows = _before(rows, ["s", "t"], "block", ["content"], "amount", "earlier")
    granted = rows.join(quotas, (F.col("s") == F.col("qs")) & (F.col("t") == F.col("qt")))
    moved = F.greatest(F.least(F.col("amount"), F.col("quota") - F.col("earlier")), F.lit(0))
    granted = granted.withColumn("moved", moved).filter("moved > 0")
    # At most two entries a shard.
    moves = granted.groupBy(F.col("content").alias("m_content")).agg(F.collect_list(F.struct("s", "t", "moved")).alias("moves"))
    joined = state.join(moves, F.col("content") == F.col("m_content"), "left")

    def sum_of(field: str, shard: Column) -> Column:
        return F.aggregate(
            F.filter("moves", lambda m: m[field] == shard), F.lit(0).cast("long"), lambda a, m: a + m["moved"]
        )

    held = F.transform("held", lambda h, i: h - sum_of("s", i) + sum_of("t", i))
    return joined.select("content", "n", F.when(F.col("moves").isNull(), F.col("held")).otherwise(held).alias("held"))


def _held_by(state: DataFrame, shards: int) -> list[int]:
    """Linked documents in each shard."""
    sums = state.agg(*[F.coalesce(F.sum(F.get("held", F.lit(s))), F.lit(0)).alias(f"s{s}") for s in range(shards)])
    return [int(x) for x in sums.first()]


def propagate(groups: DataFrame, capacity: list[int], blocks: int, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """Rows (content, n, held) after the last round. Only counts by shard come to the driver.

    Rounds end when hardly any document moves, or after `most_rounds`. A round never fills a shard beyond its
    capacity, so the outcome is balanced after any number of rounds.
    """
    shards = len(capacity)
    state = stored(_first_labels(groups, shards, blocks), "shard-labels")
    for _ in range(most_rounds):
        held = _held_by(state, shards)
        room = [most - now for most, now in zip(capacity, held, strict=True)]
        asked = stored(_proposals(state, room), "shard-proposals")
        quotas = stored(_quotas(asked, room), "shard-quotas")
        granted = quotas.agg(F.sum("quota")).first()[0] or 0
        if granted <= SETTLED * sum(held):
            break
        state = stored(_moved(state, asked, quotas, blocks), "shard-labels")
    return state


def _entries(state: DataFrame, shards: int, blocks: int) -> DataFrame:
    """For each group the stretches of its documents: (up_to, held, shard, slot of the first)."""
    parts = state.select("content", F.posexplode("held").alias("shard", "held")).filter("held > 0")
    parts = parts.withColumn("block", _spread(F.col("content"), blocks))
    parts = _before(parts, ["shard"], "block", ["content"], "held", "slot")
    listed = parts.groupBy("content").agg(F.array_sort(F.collect_list(F.struct("shard", "held", "slot"))).alias("parts"))
    up_to = F.transform(
        "parts",
        lambda p, i: F.struct(
            F.aggregate(F.slice("parts", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x["held"]).alias("up_to"),
            p["held"].alias("held"),
            p["shard"].alias("shard"),
            p["slot"].alias("slot"),
        ),
    )
    return listed.select(F.col("content").alias("e_content"), up_to.alias("entries"))


def _seated(rows: DataFrame) -> DataFrame:
    """Rows with `place` (their first copy's rank), `copies` and `entries`, one by copy, with shard and slot."""
    # Copies of a whole row are written out in runs, so that a row repeated very often needs no long array.
    run = F.lit(10_000)
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / run))))
    upper = F.least(F.col("copies") - 1, F.col("run") * run + run - 1)
    each = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * run, upper)))
    each = each.withColumn("rank", F.col("place") + F.col("copy"))
    entry = F.get(F.filter("entries", lambda e: F.col("rank") < e["up_to"]), F.lit(0))
    each = each.withColumn("entry", entry)
    return each.select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("entry.shard").cast("int").alias("shard"),
        (F.col("entry.slot") + F.col("rank") - (F.col("entry.up_to") - F.col("entry.held"))).cast("long").alias("slot"),
        F.col("n").alias("group_size"),
    )


def sharded(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = SHARDS,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, group_size.

    Row counts of two shards differ by at most one, exactly. Documents of equal text (group_size of them) share
    a shard as far as quotas allow; a group larger than a shard fills several. `slot` runs from 0 in each shard
    without a gap; `grown_shard` is NULL, as this law does not hang on the id.

    NULL text is the empty text. Ids may be NULL or repeat; rows that repeat an id and a text are combined
    before anything is shuffled and written out again at the end. Other columns are ignored. An empty
    table gives an empty result. Reruns on the same rows agree.
    """
    text = whole_text(F.col("text"))
    rows = picked(documents, doc_id=id_column, text=text_column).select(
        "doc_id",
        F.unhex(F.md5(text)).alias("content"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    counted = rows.groupBy("doc_id", "content", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    counted = stored(counted, "shard-documents")
    groups = stored(counted.groupBy("content").agg(F.sum("copies").alias("n")), "shard-groups")
    total, alone = groups.agg(F.sum("n"), F.sum((F.col("n") == 1).cast("long"))).first()
    total, alone = int(total or 0), int(alone or 0)
    blocks = _blocks(total)
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    linked = groups.filter("n > 1")
    state = propagate(linked, capacity, blocks, most_rounds)
    key = F.xxhash64("doc_id", "content")

    entries = _entries(state, shards, blocks)
    members = counted.join(linked.withColumnRenamed("content", "g_content"), F.col("content") == F.col("g_content"))
    members = members.drop("g_content").withColumn("block", _spread(key, _blocks_of(F.col("n"))))
    # Dealt by block, so that the join before may split a hot group, and its blocks go to many tasks.
    members = members.repartition("content", "block")
    members = _before(members, ["content"], "block", ["doc_id"], "copies", "place")
    seated = _seated(members.join(entries, F.col("content") == F.col("e_content")))

    single = groups.filter("n = 1").select(F.col("content").alias("g_content"), "n")
    singles = counted.join(single, F.col("content") == F.col("g_content")).drop("g_content")
    singles = _before(singles.withColumn("block", _spread(key, _blocks(alone))), [], "block", ["content"], "copies", "place")
    fill, up_to = [], 0
    for shard, (most, held) in enumerate(zip(capacity, _held_by(state, shards), strict=True)):
        up_to += most - held
        if most > held:
            numbers = {"up_to": up_to, "held": most - held, "shard": shard, "slot": held}
            fill.append(F.struct(*[F.lit(v).cast("int" if k == "shard" else "long").alias(k) for k, v in numbers.items()]))
    if fill:
        seated = seated.unionByName(_seated(singles.withColumn("entries", F.array(*fill))))
    return seated.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_size"
    )

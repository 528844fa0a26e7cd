"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Targets in words are turned into whole blocks of `block_words`: sources get blocks by highest quotients
target / (2k + 1), each source's blocks are dealt to its shards the same way, and in a shard the blocks
are the consecutive pieces of its documents in a seeded order, taken from the front, round after round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.frames import picked, stored, whole_text

_SPACE_RUN = r"[\x20\x09-\x0D]+"
_WORD_AND_SPACE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"

BLOCK_WORDS = 16
SHARD_DOCUMENTS = 1_000
MOST_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(whole_text(text), _SPACE_RUN), "")).cast("long")


def first_words(text: Column, count: Column) -> Column:
    """The text up to its count-th word, spaces kept as they are."""
    pieces = F.regexp_extract_all(text, F.lit(_WORD_AND_SPACE), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")


def apportion(parties: DataFrame, group: list[str], order: list[Column], votes: str, seats: str) -> DataFrame:
    """Add `won`: seats by highest quotients votes / (2k + 1) within each group; ties go by `order`.

    No quotient series is written out. With n parties, V votes and N seats, every party has at least its
    rounded share of N - n/2 seats and at most that of N + n/2, so only about two quotients per party are
    compared. Groups without votes win nothing.
    """
    within = W.partitionBy(*group)
    share = F.col(votes).cast("double") / F.nullif(F.sum(F.col(votes).cast("double")).over(within), F.lit(0.0))
    half = F.count(F.lit(1)).over(within) / 2
    sure = F.floor(F.coalesce(share, F.lit(0.0)) * F.greatest(F.col(seats) - half, F.lit(0.0)) + 0.5) - 1
    most = F.floor(F.coalesce(share, F.lit(0.0)) * (F.col(seats) + half) + 0.5) + 1
    bounds = parties.withColumns({"sure": F.greatest(sure, F.lit(0)).cast("long"), "most": most.cast("long")})
    open_seats = F.col(seats) - F.sum("sure").over(within)
    bounds = bounds.withColumns({"open_seats": open_seats, "party": F.row_number().over(within.orderBy(*order))})
    tried = bounds.select(*group, "party", "open_seats", votes, F.explode(F.sequence("sure", "most")).alias("k"))
    quotient = F.col(votes) / (2 * F.col("k") + 1)
    rank = F.row_number().over(within.orderBy(quotient.desc(), "party", "k"))
    won = (
        tried.filter(F.col(votes) > 0)
        .withColumn("rank", rank)
        .filter("rank <= open_seats")
        .groupBy(*[F.col(c).alias(f"won_{c}") for c in [*group, "party"]])
        .agg(F.count(F.lit(1)).alias("more"))
    )
    met = [F.col(c).eqNullSafe(F.col(f"won_{c}")) for c in [*group, "party"]]
    joined = bounds.join(won, met, "left").withColumn("won", F.col("sure") + F.coalesce("more", F.lit(0)))
    return joined.select(*parties.columns, "won")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add weight and target to one row per source (source, source_size).

    Sources by code point, NULL last, take the weights in turn and share all words. A target stops at
    three times its source's size and the rest share what it leaves: they all get level * weight, where the
    level follows from running sums over the sources in the order in which they reach their limit.
    This works on one row per source, in one task.
    """
    everything = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_limit = W.orderBy("limit_level", F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1
    )
    limit = MOST_REPEATS * F.col("source_size")
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(onward)
    levels = (
        sizes.withColumn("weight", weight)
        .withColumns({"limit": limit, "total": F.sum("source_size").over(everything)})
        .withColumn("limit_level", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("limit_level") >= F.col("level"), F.col("level"))).over(everything))
    )
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    return levels.withColumn("target", target).select(*sizes.columns, "total", "weight", "target")


def mix(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 42,
    block_words: int = BLOCK_WORDS,
    shard_documents: int = SHARD_DOCUMENTS,
    carry: list[str] | None = None,
) -> DataFrame:
    """What the mix takes of each document.

    Returns doc_id, size, source, source_size, target, taken, passes (whole copies) and extra_words (words
    from the front beyond them), and the columns in `carry`. taken = passes * size + extra_words, at most
    three times the size; all of a source come to its target but for less than a block a shard.

    A NULL text has size 0 and nothing is taken of it; a NULL source is a source. Shards and order hang on
    the id, the text and the seed alone, so reruns agree, and an id that most rows share, or lack, is spread by
    text; rows that repeat both follow each other. A source that holds most rows is cut into shards of about
    `shard_documents`. An empty table gives an empty result.
    """
    rows = picked(
        documents,
        doc_id=id_column,
        mix_text=text_column,
        source=source_column,
        **{f"carried_{i}": name for i, name in enumerate(carry or [])},
    )
    sized = rows.withColumns({"size": word_count(F.col("mix_text")), "mark": F.xxhash64("mix_text")}).drop("mix_text")
    if not carry:
        sized = stored(sized, "mix-sizes")
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_documents")
    )
    counts = stored(per_source, "mix-sources")
    targets = source_targets(counts).withColumns(
        {"blocks": F.round(F.col("total") / block_words).cast("long"), "mix": F.lit(1)}
    )
    quotas = apportion(targets, ["mix"], [F.col("source").asc_nulls_last()], "target", "blocks")
    quotas = stored(
        quotas.select(
            F.col("source").alias("of_source"),
            "source_size",
            "target",
            F.col("won").alias("source_blocks"),
            (F.floor(F.col("source_documents") / shard_documents) + 1).alias("shards"),
        ),
        "mix-quotas",
    )
    dealt = (
        sized.join(quotas, F.col("source").eqNullSafe(F.col("of_source")))
        .drop("of_source")
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "mark"), F.col("shards")))
    )
    shards = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_blocks").alias("source_blocks")
    )
    shards = apportion(shards, ["source"], [F.col("shard")], "shard_size", "source_blocks").select(
        F.col("source").alias("s_source"), F.col("shard").alias("s_shard"), "shard_size", F.col("won").alias("quota")
    )
    seeded = F.xxhash64(F.lit(seed + 1), "doc_id", "mark")
    in_order = W.partitionBy("source", "shard").orderBy(seeded, "doc_id", "mark", "size")
    before = F.coalesce(F.sum("size").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.withColumn("before", before).join(
        shards, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("shard") == F.col("s_shard"))
    )
    wanted = F.least(F.col("quota") * block_words, MOST_REPEATS * F.col("shard_size"))
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("wanted") / F.col("shard_size"))).otherwise(F.lit(0))
    rest = F.col("wanted") - F.col("passes") * F.col("shard_size")
    extra = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("size"))
    result = (
        placed.withColumn("wanted", wanted)
        .withColumn("passes", passes.cast("long"))
        .withColumn("rest", rest)
        .withColumn("extra_words", extra.cast("long"))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("extra_words"))
    )
    return result.select(
        "doc_id", "size", "source", "source_size", "target", "taken", "passes", "extra_words",
        *[F.col(f"carried_{i}") for i in range(len(carry or []))],
    )


def mixed_documents(documents: DataFrame, columns: list[str], seed: int = 42) -> DataFrame:
    """The documents as often as the mix takes them; the last copy may be cut after a word."""
    taken = mix(documents, seed=seed, carry=columns)
    taken = taken.select(
        *[F.col(f"carried_{i}").alias(name) for i, name in enumerate(columns)],
        F.col("passes").alias("_passes"),
        F.col("extra_words").alias("_extra"),
        F.col("size").alias("_size"),
    )
    copies = F.col("_passes") + (F.col("_extra") > 0).cast("long")
    repeated = taken.filter(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    cut = (F.col("_copy") > F.col("_passes")) & (F.col("_extra") < F.col("_size"))
    text = F.when(cut, first_words(F.col("text"), F.col("_extra"))).otherwise(F.col("text"))
    repeated = repeated.withColumn("text", text)
    n_chars = F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return repeated.withColumn("n_chars", n_chars).select(*columns)

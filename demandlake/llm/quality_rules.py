"""Quality rules whose limits adapt to language and source.

Each document gets counts; ratios of counts, in whole thousandths, go into histogram sketches per language,
source and rule. A bin keeps the seven leading binary digits, so a sketch has a bounded number of bins and
a relative error of 1/64, and sketches merge exactly by adding counts. Quartiles read from them
give each group its limits, and one join applies these to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlake.llm.frames import picked, stored
from demandlake.llm.words import covered, find_words, mixed, row_slices, text_bytes, windows

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
LEAST_WORDS = 50
REPEAT_WINDOW = 3
MOST_REPEATED_PERCENT = 50

#: Rule: numerator, denominator, and the distance (in thousandths) that any document may lie from the quartiles.
RULES = {
    "symbols": ("n_symbols", "n_words", 150),
    "dup_lines": ("n_dup_lines", "n_lines", 450),
    "repeats": ("n_repeat_words", "n_words", 350),
    "upper": ("n_upper", "word_chars", 150),
    "word_length": ("word_chars", "n_words", 1000),
}
LOWER_TOO = ("word_length",)
SPREADS = 3
# What the language's sketch weighs in that of each of its sources, in texts.
COMMON_TEXTS = 100

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

_IS_SYMBOL = np.zeros(256, dtype=np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_words(words) -> np.ndarray:
    """Words of each row in windows that occur in the row at least twice."""
    row, place, hashes = windows(words, REPEAT_WINDOW)
    keys = mixed(hashes + (row + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    marked = covered(words.first[row[again]] + place[again], REPEAT_WINDOW, len(words.starts))
    return _per_row(marked, words.first)


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of COUNTS for every text of an Arrow column."""
    data, offsets = text_bytes(texts)
    parts: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS}
    for low, high in row_slices(offsets):
        bounds = offsets[low : high + 1] - offsets[low]
        piece = data[offsets[low] : offsets[high]]
        words = find_words(piece, bounds)
        space = (piece == 32) | ((piece >= 9) & (piece <= 13))
        parts["n_words"].append(np.diff(words.first))
        parts["word_chars"].append(_per_row(~space & ((piece & 0xC0) != 0x80), bounds))
        parts["n_symbols"].append(_per_row(_IS_SYMBOL[piece], bounds))
        # Capitals of ASCII, and of Latin-1 (lead byte C3, second byte 80 to 9E but 97).
        upper = (piece >= 65) & (piece <= 90)
        upper[1:] |= (piece[:-1] == 0xC3) & (piece[1:] >= 0x80) & (piece[1:] <= 0x9E) & (piece[1:] != 0x97)
        parts["n_upper"].append(_per_row(upper, bounds))
        parts["n_repeat_words"].append(_repeated_words(words))
        lines = [
            [line for line in piece[a:b].tobytes().split(b"\n") if line.strip(SPACES)]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        parts["n_lines"].append(np.array([len(of_row) for of_row in lines], dtype=np.int64))
        parts["n_dup_lines"].append(np.array([len(of_row) - len(set(of_row)) for of_row in lines], dtype=np.int64))
    return {name: np.concatenate(values) if values else np.zeros(0, np.int64) for name, values in parts.items()}


def with_counts(rows: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with the counts of their text added."""
    at = rows.columns.index(text_column)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_counts(batch.column(at))
            arrays = [*batch.columns, *[pa.array(counts[name], pa.int64()) for name in COUNTS]]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *COUNTS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(compute, ", ".join([*fields, *[f"{name} long" for name in COUNTS]]))


def _ratio(rule: str) -> Column:
    """In whole thousandths; NULL where the denominator is 0."""
    numerator, denominator, _ = RULES[rule]
    return F.expr(f"(1000 * {numerator}) div nullif({denominator}, 0)")


def _bin(value: Column) -> Column:
    """The value with all but its seven leading binary digits set to 0."""
    spare = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def different_texts(counted: DataFrame) -> DataFrame:
    """One row per language, source and text of the documents that pass the base rules."""
    rows = counted.filter(~base_failed()).select("lang", "source", "text_hash", *COUNTS)
    # Copies are combined before the shuffle: each task sends a text that a third of all rows repeat once.
    return rows.distinct()


def sketches(counted: DataFrame, group: list[str]) -> DataFrame:
    """Mergeable sketches: rows (*group, rule, bin, n)."""
    values = F.explode(
        F.array(*[F.struct(F.lit(rule).alias("rule"), _ratio(rule).alias("value")) for rule in RULES])
    ).alias("v")
    return (
        counted.select(*group, values)
        .filter("v.value is not null")
        .groupBy(*group, F.col("v.rule").alias("rule"), _bin(F.col("v.value")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def blended(own: DataFrame, common: DataFrame) -> DataFrame:
    """The sketches of all groups (lang, source), each merged with that of its language at the weight of COMMON_TEXTS texts.

    A group of few texts follows its language, a large one itself, and there is no size at which that turns.
    Weights are whole numbers: a group's count times the language's total, and the language's count times
    COMMON_TEXTS.
    """
    exact = "decimal(38,0)"
    totals = common.groupBy(F.col("lang").alias("t_lang"), F.col("rule").alias("t_rule")).agg(F.sum("n").alias("all_texts"))
    met = F.col("lang").eqNullSafe(F.col("t_lang")) & (F.col("rule") == F.col("t_rule"))
    weight = (F.col("n").cast("decimal(19,0)") * F.col("all_texts").cast("decimal(19,0)")).cast(exact)
    weighed = own.join(totals, met).select("lang", "source", "rule", "bin", weight.alias("n"))
    groups = own.select(F.col("lang").alias("t_lang"), "source", F.col("rule").alias("t_rule")).distinct()
    lent = common.join(groups, met).select("lang", "source", "rule", "bin", (F.col("n") * COMMON_TEXTS).cast(exact).alias("n"))
    return weighed.unionByName(lent).groupBy("lang", "source", "rule", "bin").agg(F.sum("n").cast(exact).alias("n"))


def _quartiles(bins: DataFrame, group: list[str]) -> DataFrame:
    """q1, q2 and q3 of every group and rule: the least bin at which one, two or three quarters are reached."""
    within = W.partitionBy(*group, "rule")
    reached = F.sum("n").over(within.orderBy("bin"))
    return (
        bins.withColumns({"reached": reached, "total": F.sum("n").over(within)})
        .groupBy(*group, "rule")
        .agg(
            F.min(F.when(F.expr("4 * reached >= total"), F.col("bin"))).alias("q1"),
            F.min(F.when(F.expr("2 * reached >= total"), F.col("bin"))).alias("q2"),
            F.min(F.when(F.expr("4 * reached >= 3 * total"), F.col("bin"))).alias("q3"),
        )
    )


def limits(counted: DataFrame) -> DataFrame:
    """Rows (lang, source, least_<rule>, most_<rule>), one per group with a document that passes the base rules.

    A limit lies three quartile distances, and at least the rule's slack, beyond the quartile of the group's
    sketch, blended with its language's. No limit lies beyond that of the language alone, which is measured from
    the median and the nearer quartile, twice as far: up to half of a language's texts may be junk on one side
    without moving it far, and a source full of junk does not set its own.
    """
    different = different_texts(counted)
    # Stored, as both are read more than once: by group and bin, they are small.
    of_language = stored(sketches(different.drop("source").distinct(), ["lang"]), "language-sketches")
    of_group = stored(sketches(different, ["lang", "source"]), "group-sketches")
    own = _quartiles(blended(of_group, of_language), ["lang", "source"])
    common = _quartiles(of_language, ["lang"])
    common = common.select(
        F.col("lang").alias("c_lang"), F.col("rule").alias("c_rule"), *[F.col(q).alias(f"c_{q}") for q in ("q1", "q2", "q3")]
    )
    both = own.join(common, F.col("lang").eqNullSafe(F.col("c_lang")) & (F.col("rule") == F.col("c_rule")))
    aggregates = []
    for rule, (_, _, slack) in RULES.items():
        of_rule = F.col("rule") == rule
        reach = F.greatest(SPREADS * (F.col("q3") - F.col("q1")), F.lit(slack))
        nearer = F.least(F.col("c_q3") - F.col("c_q2"), F.col("c_q2") - F.col("c_q1"))
        bound = F.greatest(2 * SPREADS * nearer, F.lit(slack))
        most = F.least(F.col("q3") + reach, F.col("c_q2") + bound)
        aggregates.append(F.max(F.when(of_rule, most)).alias(f"most_{rule}"))
        if rule in LOWER_TOO:
            least = F.greatest(F.col("q1") - reach, F.col("c_q2") - bound)
            aggregates.append(F.max(F.when(of_rule, least)).alias(f"least_{rule}"))
    return both.groupBy("lang", "source").agg(*aggregates)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def judged(counted: DataFrame, group_limits: DataFrame) -> DataFrame:
    """Add base_failed and kept to counted rows."""
    named = group_limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    met = counted.join(
        named, counted["lang"].eqNullSafe(named["of_lang"]) & counted["source"].eqNullSafe(named["of_source"]), "left"
    )
    verdict = ~base_failed()
    for rule in RULES:
        verdict &= F.coalesce(_ratio(rule) <= F.col(f"most_{rule}"), F.lit(True))
        if rule in LOWER_TOO:
            verdict &= F.coalesce(_ratio(rule) >= F.col(f"least_{rule}"), F.lit(True))
    return met.withColumns({"base_failed": base_failed(), "kept": verdict}).drop(*named.columns)


def quality_rules(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed and kept.

    Of the documents that pass the base rules, each different text enters the sketch of its group once, told apart
    by its 64-bit hash and its counts. NULL text has no words and fails the base rules; NULL
    languages and sources are groups of their own. Two windows or words count as equal if their 64-bit
    hashes within one text are. Rows that repeat an id each get their row; an empty table gives an empty
    result.
    """
    rows = picked(documents, doc_id=id_column, text=text_column, lang=lang_column, source=source_column)
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    counted = stored(with_counts(hashed).drop("text"), "quality-counts")
    return judged(counted, limits(counted)).drop("text_hash")


def keep_good(documents: DataFrame, columns: list[str]) -> DataFrame:
    """The documents that the rules keep, unchanged."""
    rows = documents.select(*columns)
    hashed = rows.select("text", "lang", "source", F.xxhash64("text").alias("text_hash"))
    counted = stored(with_counts(hashed).drop("text"), "quality-counts")
    group_limits = stored(limits(counted), "quality-limits")
    return judged(with_counts(rows), group_limits).filter("kept").select(*columns)

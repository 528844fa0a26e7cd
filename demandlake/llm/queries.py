"""The registered queries of the operators, over the whole given tables, and SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm import (
    conversation_repair,
    exact_dedup,
    hard_negatives,
    lm_scores,
    mixing,
    packing,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_files,
)
from demandlake.llm.frames import read
from demandlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(read(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_files.token_files(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.lm_scores(read(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeated_bytes(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repairs(conversation_repair.damage(read(spark, sf_dir, "conversations")))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"))


_QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_files": op4_token_files,
    "op5_quality_model": op5_quality_model,
    "op6_lm_scores": op6_lm_scores,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sharding": op12_sharding,
    "op13_hard_negatives": op13_hard_negatives,
}


def prepared(query: Query) -> Query:
    """The query on a configured session whose Python workers can import this package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = str(Path(__file__).resolve().parent.parent.parent)
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
        return query(configure(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {name: prepared(query) for name, query in _QUERIES.items()}


def _repair_sql() -> str:
    """Damage, faults and the cheapest edits in SQL: one recursion step takes a row of every conversation.

    s0 to s3 are the best edits so far that end before any turn, after system, user or assistant: cost c, audit a
    and lines o. Inserts are tried three times before each row and after the last.
    """

    def put(state: str, cost: str, edit: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {state}.o || {line}}}"

    def best(*choices: str) -> str:
        listed = ", ".join(choices)
        return f"list_sort([{listed}])[1]"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    carried = "conv_id, k"
    inserted = "FROM_HERE"
    for _ in range(3):
        u = best("s2", *[put(s, "3", "I", user) for s in ("s0", "s1", "s3")])
        a = best("s3", put("s2", "3", "I", assistant))
        inserted = inserted.replace("FROM_HERE", f"(SELECT {carried}, s0, s1, {u} AS s2, {a} AS s3 FROM FROM_HERE)")
    line = "chr(10) || role || ':' || text"
    far = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 'o': ''}"

    def kept(initial: str, *states: str) -> list[str]:
        held = f"free AND left(role, 1) = '{initial}'"
        return [f"CASE WHEN {held} THEN {put(s, 'more', 'K', line)} ELSE {far} END" for s in states]

    def led(role: str, *states: str) -> list[str]:
        return [f"CASE WHEN free THEN {put(s, '3 + more', 'R', f'{role} || text')} ELSE {far} END" for s in states]

    step = ", ".join(
        f"{best(put(state, '4', 'D'), *choices)} AS {state}"
        for state, choices in {
            "s0": [],
            "s1": kept("s", "s0"),
            "s2": kept("u", "s0", "s1", "s3") + led(user, "s0", "s1", "s3"),
            "s3": kept("a", "s2") + led(assistant, "s2"),
        }.items()
    )
    crc = (
        "xor(list_reduce(list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),"
        " lambda crc, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, b)),"
        " CAST(4294967295 AS BIGINT)), 4294967295)"
    )
    some = r"[^\x20\x09-\x0D]"
    return rf"""
        WITH RECURSIVE given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations),
        ruled AS (SELECT *, {crc} % 20 AS rule FROM given),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
                CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(generate_series(1, CASE rule WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM ruled),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS k
            FROM damaged),
        marked AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '{some}') THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS earlier
            FROM placed),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (earlier IS NOT NULL AND earlier || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
                max(k) AS n
            FROM marked GROUP BY conv_id),
        steps AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS k, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS s0,
                {far} AS s1, {far} AS s2, {far} AS s3
            FROM counted
            UNION ALL
            SELECT conv_id, k, {step}
            FROM (
                SELECT i.conv_id, m.k, s0, s1, s2, s3, m.role, m.text, m.fault NOT IN ('blank', 'duplicate') AS free,
                    CASE m.fault WHEN 'truncated' THEN 3 ELSE 0 END AS more
                FROM {inserted.replace("FROM_HERE", "steps")} AS i
                JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM i.conv_id AND m.k = i.k + 1) AS met),
        ended AS (
            SELECT conv_id, k, {best("s0", "s3")} AS e FROM {inserted.replace("FROM_HERE", "steps")} AS i)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost,
            coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.o, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c
        LEFT JOIN counted AS f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended AS d ON d.conv_id IS NOT DISTINCT FROM c.conv_id AND d.k = f.n"""


def _rules_sql() -> str:
    """The counts, the blended sketches and their limits, and the verdicts in SQL."""
    some = r"[^\x20\x09-\x0D]"
    rules = quality_rules.RULES
    values = ", ".join(f"{{'rule': '{rule}', 'value': 1000 * {top} // nullif({bottom}, 0)}}" for rule, (top, bottom, _) in rules.items())
    slack = "CASE rule " + " ".join(f"WHEN '{rule}' THEN {least}" for rule, (_, _, least) in rules.items()) + " END"
    lower = "rule IN (" + ", ".join(f"'{rule}'" for rule in quality_rules.LOWER_TOO) + ")"
    failed = f"n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words"

    def quartiles(bins: str, group: str) -> str:
        return f"""(SELECT {group}, rule, min(bin) FILTER (4 * reached >= total) AS q1, min(bin) FILTER (2 * reached >= total) AS q2,
                min(bin) FILTER (4 * reached >= 3 * total) AS q3
            FROM (SELECT *, sum(n) OVER (PARTITION BY {group}, rule ORDER BY bin) AS reached,
                sum(n) OVER (PARTITION BY {group}, rule) AS total FROM {bins}) AS s GROUP BY {group}, rule)"""

    def sketch(rows: str, group: str) -> str:
        return f"""(SELECT {group}, v.rule AS rule, (v.value >> spare) << spare AS bin, count(*) AS n
            FROM (SELECT *, greatest(length(bin(v.value)) - 7, 0) AS spare FROM
                (SELECT {group}, unnest([{values}]) AS v FROM {rows}) AS u WHERE v.value IS NOT NULL) AS b
            GROUP BY {group}, rule, bin)"""

    columns = "n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper"
    return rf"""
        WITH given AS (
            SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '{some}+') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '{some}')) AS lines
            FROM documents),
        places AS (
            SELECT row_id, words, unnest(generate_series(1, len(words) - 2)) AS place FROM given WHERE len(words) > 2),
        threes AS (SELECT row_id, place, array_to_string(words[place:place + 2], ' ') AS content FROM places),
        again AS (SELECT row_id, place FROM threes QUALIFY count(*) OVER (PARTITION BY row_id, content) > 1),
        covered AS (
            SELECT row_id, count(DISTINCT place + step) AS n FROM again, range(0, 3) AS steps(step) GROUP BY row_id),
        counted AS (
            SELECT g.row_id, doc_id, lang, source, text, CAST(len(words) AS BIGINT) AS n_words,
                CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
                CAST(len(regexp_extract_all(text, '[A-ZÀ-ÖØ-Þ]')) AS BIGINT) AS n_upper
            FROM given AS g LEFT JOIN covered AS c ON c.row_id = g.row_id),
        own_texts AS (SELECT DISTINCT lang, source, text, {columns} FROM counted WHERE NOT ({failed})),
        own AS {sketch("own_texts", "lang, source")},
        common AS {sketch("(SELECT DISTINCT lang, text, " + columns + " FROM own_texts) AS t", "lang")},
        totals AS (SELECT lang, rule, sum(n) AS all_texts FROM common GROUP BY lang, rule),
        blended AS (
            SELECT lang, source, rule, bin, sum(n) AS n FROM (
                SELECT o.lang, o.source, o.rule, o.bin, o.n * t.all_texts AS n FROM own AS o
                JOIN totals AS t ON t.lang IS NOT DISTINCT FROM o.lang AND t.rule = o.rule
                UNION ALL
                SELECT g.lang, g.source, g.rule, c.bin, c.n * {quality_rules.COMMON_TEXTS}
                FROM (SELECT DISTINCT lang, source, rule FROM own) AS g
                JOIN common AS c ON c.lang IS NOT DISTINCT FROM g.lang AND c.rule = g.rule) AS merged
            GROUP BY lang, source, rule, bin),
        reaches AS (
            SELECT o.lang, o.source, o.rule, o.q1, o.q3, c.q2 AS c2,
                greatest({quality_rules.SPREADS} * (o.q3 - o.q1), {slack.replace("rule", "o.rule", 1)}) AS reach,
                greatest({2 * quality_rules.SPREADS} * least(c.q3 - c.q2, c.q2 - c.q1), {slack.replace("rule", "o.rule", 1)}) AS bound
            FROM {quartiles("blended", "lang, source")} AS o
            JOIN {quartiles("common", "lang")} AS c ON c.lang IS NOT DISTINCT FROM o.lang AND c.rule = o.rule),
        judged AS (
            SELECT row_id, bool_or(coalesce(v.value > least(q3 + reach, c2 + bound), false)
                OR ({lower.replace("rule", "l.rule", 1)} AND coalesce(v.value < greatest(q1 - reach, c2 - bound), false))) AS bad
            FROM (SELECT row_id, lang, source, unnest([{values}]) AS v FROM counted) AS d
            JOIN reaches AS l ON l.lang IS NOT DISTINCT FROM d.lang AND l.source IS NOT DISTINCT FROM d.source AND l.rule = d.v.rule
            GROUP BY row_id)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
            NOT ({failed}) AND NOT coalesce(j.bad, false) AS kept
        FROM counted AS c LEFT JOIN judged AS j ON j.row_id = c.row_id"""


ORACLES: dict[str, str] = {
    "op9_quality_rules": _rules_sql(),
    "op11_conversation_repair": _repair_sql(),
    "op1_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
        FROM t JOIN g USING (text)""",
    "op3_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        p AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS place FROM w WHERE len(words) >= 35),
        s AS (SELECT doc_id, place, array_to_string(words[place:place + 34], ' ') AS content FROM p),
        r AS (SELECT doc_id, place FROM s QUALIFY count(*) OVER (PARTITION BY content) > 1),
        gone AS (SELECT DISTINCT doc_id, place + step AS n FROM r, range(0, 35) AS steps(step)),
        one AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS n FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY n) AS text FROM one ANTI JOIN gone USING (doc_id, n) GROUP BY doc_id),
        removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
            sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)""",
    "op13_hard_negatives": """
        WITH fine AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, p.vec_id, a.label = p.label AS same,
                CAST(list_sum(list_transform(generate_series(1, least(len(a.v), len(p.v))), lambda i: a.v[i] * p.v[i])) AS BIGINT) AS score
            FROM fine a JOIN fine p ON a.vec_id IS DISTINCT FROM p.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
}

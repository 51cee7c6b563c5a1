"""Quality rules as a short-circuit cascade, ordered by rejections per cost measured on a sample.

Everything on the main path is a built-in expression: texts are split into arrays, and all counts
are array and string functions of one row, so a run is a single scan without a shuffle.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import BLANKS, free_name, table, words_of, written

SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
COPIES = 40
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over ``text`` and the base columns; true means that the text goes."""

    name: str
    rejects: str


RULES = (
    Rule("symbols", "4 * n_symbols > n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("shouting", "2 * length(regexp_replace(text, '[^A-Z]+', '')) > word_chars"),
    Rule("few_letters", r"2 * (length(text) - length(regexp_replace(text, '[!-@\\[-`{-~]+', ''))) > word_chars"),
)


def _covered(positions: Column) -> Column:
    """Words under windows that begin at the sorted ``positions``: a window adds what the next leaves it."""
    gaps = F.zip_with(
        F.slice(positions, 1, F.size(positions) - 1),
        F.slice(positions, 2, F.size(positions)),
        lambda a, b: F.least(F.lit(WINDOW), b - a),
    )
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap) + F.lit(WINDOW)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the ``BASE`` columns and ``base_failed``.

    A 5-word window is told apart from others of its text by the 64-bit hash of its words. Null,
    empty and blank texts have no words, zero counts, and fail. Repeated rows are judged alike.
    """
    kept = docs.columns
    bare = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(bare, "\n"), lambda line: F.length(F.trim(line, F.lit(BLANKS))) > 0)
    counted = (
        docs.withColumn("_words", words_of(F.col(text)))
        .withColumn("_lines", lines)
        .withColumn(
            "_hashes",
            F.when(
                F.size("_words") > WINDOW,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
                ),
            ),
        )
        # only a text with some window twice is sorted and measured
        .withColumn(
            "_sorted",
            F.when(
                F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
                F.sort_array(
                    F.arrays_zip(F.col("_hashes").alias("h"), F.sequence(F.lit(1), F.size("_hashes")).alias("i"))
                ),
            ),
        )
        # sorted neighbours with one hash are windows that stand twice
        .withColumn(
            "_twice",
            F.zip_with(
                "_sorted",
                F.slice("_sorted", 2, F.size("_sorted")),
                lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
            ),
        )
        .withColumn(
            "_starts", F.sort_array(F.array_distinct(F.flatten(F.filter("_twice", lambda pair: pair.isNotNull()))))
        )
    )
    symbols = F.length(bare) - F.length(F.regexp_replace(bare, SYMBOLS, ""))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": symbols,
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(_covered(F.col("_starts")), F.lit(0)),
        "n_lines": F.size("_lines"),
    }
    measured = counted.select(*kept, *[c.cast("bigint").alias(n) for n, c in counts.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> list[Rule]:
    """``rules`` by rejections per cost on a sample of about ``sample_rows`` rows, best first.

    A rule's cost is the time that it adds to a job over the sample, every row of it ``COPIES`` times, so that it
    stands out from what a job's time varies by; rules that do not stand out cost that much. Rejections are those
    among the rows that the rules chosen before leave. The sample decides the order only; every row meets
    the same rules whatever the order. Rules that reject nothing more go last, cheapest first.
    """
    total = docs.count()
    if total == 0 or len(rules) < 2:
        return list(rules)
    sample = written(base_counts(docs.select("text").sample(min(1.0, sample_rows / total), seed=11)), "rule-sample")
    left = sample.where(~F.col("base_failed")).select("text", *BASE)
    many = left.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def timed(condition: Column) -> float:
        start = time.perf_counter()
        many.agg(F.count_if(condition)).collect()
        return time.perf_counter() - start

    timed(F.lit(False))  # the first run compiles
    nothing = [timed(F.col("copy") < 0) for _ in range(3)]
    least = max(max(nothing) - min(nothing), 1e-3)
    costs = {rule.name: max(timed(F.expr(rule.rejects)) - min(nothing), least) for rule in rules}
    waiting, ordered = list(rules), []
    while waiting:
        rejected = left.agg(*[F.count_if(F.expr(rule.rejects)) for rule in waiting]).first()
        ranked = [(-n / costs[rule.name], costs[rule.name], place) for place, (rule, n) in enumerate(zip(waiting, rejected))]
        ordered.append(waiting.pop(min(ranked)[2]))
        left = left.where(~F.coalesce(F.expr(ordered[-1].rejects), F.lit(False)))
    return ordered


def quality_verdict(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """``docs`` (with ``text``) plus the ``BASE`` columns, ``base_failed`` and ``kept``.

    Rules are tried in the order of ``cascade_order`` and stop at the first that rejects; a text that
    failed the base is not tried at all. Columns of ``docs`` that have the name of a result are
    replaced. An empty table gives an empty table.
    """
    ordered = cascade_order(docs, rules, sample_rows)
    results = {*BASE, "base_failed", "kept"}
    verdict = F.when(F.col("base_failed"), False)
    for rule in ordered:
        verdict = verdict.when(F.expr(rule.rejects), False)
    own = docs.select(*[c for c in docs.columns if c.lower() not in results])
    return base_counts(own).withColumn("kept", verdict.otherwise(True))


def op2_quality_rules(spark, sf_dir):
    judged = quality_verdict(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *BASE[:5], "base_failed", "kept")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with their own columns unchanged."""
    key = free_name(docs, "judged_text")
    judged = quality_verdict(docs.select(F.struct(*docs.columns).alias(key), "text"))
    # a filter would be pushed below the counts and repeat them; an array of the row, or none, is not
    return judged.select(F.explode(F.when(F.col("kept"), F.array(key))).alias(key)).select(f"{key}.*")


OP2_SQL = r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
), grams AS (
    SELECT doc_id, i, ws[i:i + 4] AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5)
), twice AS (
    SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM grams JOIN twice USING (doc_id, g))
    GROUP BY doc_id
), base AS (
    SELECT doc_id, text, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
    FROM w LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > word_chars
            OR 2 * length(regexp_replace(text, '[^!-@\[-`{-~]+', '', 'g')) > word_chars) AS kept
FROM judged
"""

"""Mixing to target weights: raking (iterative proportional fitting), then sampling by calibrated chance.

Documents are reduced to cells first (source, language, topic: tokens), however hot a source is. Raking
keeps one factor for each value of each margin: the weight of a cell is its tokens times its three
factors. One update is one small grouped sum over the cells, whose result is written, so the plan stays
short and a lost executor costs a re-read.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import free_name, table, word_count, written

MARGINS = ("source", "lang", "topic")
# A value's target share is its own share to this power, so that large sources give way to small ones.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.7}
BUDGET = 0.75
ROUNDS = 40
TOLERANCE = 1e-9
SEED = "mix-1"


def topic_of(text: Column) -> Column:
    """A topic by what a text holds; the first that fits."""
    body = F.coalesce(text, F.lit(""))
    lower = F.lower(body)
    return (
        F.when(F.contains(lower, F.lit("license")) | F.contains(lower, F.lit("copyright")), "legal")
        .when(F.contains(body, F.lit("@")) | F.contains(body, F.lit("://")), "contact")
        .when(F.contains(body, F.lit(" | ")), "table")
        .otherwise("prose")
    )


def chance(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on ``doc_id`` and ``seed`` only, so that a rerun draws the same."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def tempered_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """``value``, ``target``: shares of the values of ``margin`` to ``power``, made to add up to one."""
    shares = cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("raw"))
    shares = written(shares, f"shares-{margin}")
    total = shares.agg(F.sum("raw").alias("total"))
    return shares.select("value", (F.col("raw") / total.scalar()).alias("target"))


def _with_factor(cells: DataFrame, factors: DataFrame, margin: str) -> DataFrame:
    named = factors.select(F.col("value").alias(f"_{margin}"), F.col("factor").alias(f"_f_{margin}"))
    return cells.join(named, F.col(margin).eqNullSafe(F.col(f"_{margin}"))).drop(f"_{margin}")


def raked_factors(
    cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> dict[str, DataFrame]:
    """For each margin ``value``, ``factor``: tokens times factors then add up to the targets.

    Stops when a round moves no factor by more than ``tolerance`` of itself. Targets that no weights
    can meet leave the last margin exact and the others as near as ``rounds`` rounds bring them; then a warning
    tells how far off they are, which ``residual`` gives for any factors.
    """
    factors = {m: targets[m].select("value", F.lit(1.0).alias("factor")) for m in targets}
    for _ in range(rounds):
        moved = 0.0
        for margin in targets:
            weighed, product = cells, F.col("tokens").cast("double")
            for other in targets:
                if other != margin:
                    weighed = _with_factor(weighed, factors[other], other)
                    product = product * F.col(f"_f_{other}")
            mass = weighed.groupBy(F.col(margin).alias("of")).agg(F.sum(product).alias("mass"))
            old = factors[margin].select(F.col("value").alias("was"), F.col("factor").alias("before"))
            fresh = (
                mass.join(targets[margin], F.col("of").eqNullSafe(F.col("value")))
                .join(old, F.col("of").eqNullSafe(F.col("was")))
                .select(F.col("of").alias("value"), (F.col("target") / F.col("mass")).alias("factor"), "before")
            )
            fresh = written(fresh, f"factors-{margin}")
            step = fresh.agg(F.max(F.abs(F.col("factor") / F.col("before") - 1))).first()[0]
            moved = max(moved, step or 0.0)
            factors[margin] = fresh.select("value", "factor")
        if moved <= tolerance:
            return factors
    warnings.warn(f"raking has not settled in {rounds} rounds: a share is off by {residual(cells, factors, targets):.2e}", stacklevel=2)
    return factors


def residual(cells: DataFrame, factors: dict[str, DataFrame], targets: dict[str, DataFrame]) -> float:
    """The most by which a value's weighted share is off its target, over all margins."""
    weighed, product = cells, F.col("tokens").cast("double")
    for margin in targets:
        weighed = _with_factor(weighed, factors[margin], margin)
        product = product * F.col(f"_f_{margin}")
    weighed = written(weighed.select(*targets, product.alias("mass")), "weighed-cells")
    off = 0.0
    for margin in targets:
        mass = weighed.groupBy(F.col(margin).alias("of")).agg(F.sum("mass").alias("mass"))
        apart = mass.join(targets[margin], F.col("of").eqNullSafe(F.col("value"))).agg(F.max(F.abs(F.col("mass") - F.col("target")))).first()[0]
        off = max(off, apart or 0.0)
    return off


def sampling_rates(cells: DataFrame, factors: dict[str, DataFrame], budget: float = BUDGET) -> DataFrame:
    """The margins and ``probability`` of every cell, so that ``budget`` of all tokens is expected.

    Probabilities follow the raked weights; a cell that would need more than certainty is taken whole,
    and the others share what is left of the budget.
    """
    product = F.lit(1.0)
    for margin in factors:
        cells = _with_factor(cells, factors[margin], margin)
        product = product * F.col(f"_f_{margin}")
    rates = written(cells.select(*factors, "tokens", product.alias("rate")), "cell-rates")
    wanted = budget * (rates.agg(F.sum("tokens")).first()[0] or 0)
    scale, whole = 0.0, -1
    while True:
        full = F.col("rate") * scale >= 1
        taken, rest, cells_whole = rates.agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)),
            F.sum(F.when(~full, F.col("tokens") * F.col("rate"))),
            F.count_if(full),
        ).first()
        if cells_whole == whole or not rest:
            break
        scale, whole = (wanted - taken) / rest, cells_whole
    return rates.select(*factors, F.least(F.lit(1.0), F.col("rate") * scale).alias("probability"))


def mixture(
    docs: DataFrame,
    temper: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    budget: float = BUDGET,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` plus ``topic``, ``n_tokens``, ``probability`` and ``sampled``.

    ``docs`` needs ``doc_id``, ``text``, ``source`` and ``lang``; columns named like a result are
    replaced. ``targets`` gives ``value``, ``target`` per margin; without it they come from ``temper``.
    A null source or language is a value of its own. Tokens are words; a text without any takes its
    cell's chance, or one if its cell has no tokens at all. Rows with one ``doc_id`` share one fate.
    An empty table gives an empty table.
    """
    results = {"topic", "n_tokens", "probability", "sampled"}
    own = docs.select(*[c for c in docs.columns if c.lower() not in results])
    measured = own.withColumn("topic", topic_of(F.col("text"))).withColumn("n_tokens", word_count(F.col("text")))
    cells = written(measured.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "cells")
    if targets is None:
        powers = temper or TEMPER
        targets = {m: written(tempered_targets(cells, m, powers[m]), f"targets-{m}") for m in MARGINS}
    rates = written(sampling_rates(cells, raked_factors(cells, targets), budget), "rates")
    names = {m: free_name(own, f"cell_{m}") for m in MARGINS}
    rates = rates.select(*[F.col(m).alias(names[m]) for m in MARGINS], "probability")
    same = F.lit(True)
    for margin in MARGINS:
        same = same & F.col(margin).eqNullSafe(F.col(names[margin]))
    drawn = measured.join(rates, same, "left").drop(*names.values())
    drawn = drawn.withColumn("probability", F.coalesce("probability", F.lit(1.0)))
    return drawn.withColumn("sampled", chance(F.col("doc_id"), seed) < F.col("probability"))


def op10_mixing(spark, sf_dir):
    mixed = mixture(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return mixed.select("doc_id", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn, with their own columns unchanged."""
    key = free_name(docs, "mixed_row")
    needed = docs.select(F.struct(*docs.columns).alias(key), "doc_id", "text", "source", "lang")
    return mixture(needed).where("sampled").select(f"{key}.*")


def _oracle(rounds: int = 25, scalings: int = 8) -> str:
    """The same raking as plain SQL: every update and every scaling is a step of its own."""
    steps = [
        """docs AS (
    SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
           CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'copyright') THEN 'legal'
                WHEN contains(text, '@') OR contains(text, '://') THEN 'contact'
                WHEN contains(text, ' | ') THEN 'table' ELSE 'prose' END AS topic
    FROM documents
)""",
        """cells AS MATERIALIZED (
    SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0
)""",
    ]
    for margin in MARGINS:
        steps.append(
            f"t_{margin} AS MATERIALIZED (SELECT {margin}, raw / sum(raw) OVER () AS target FROM "
            f"(SELECT {margin}, pow(sum(tokens), {TEMPER[margin]}) AS raw FROM cells GROUP BY {margin}))"
        )
        steps.append(f"f_{margin}_0 AS (SELECT {margin}, 1.0::DOUBLE AS factor FROM t_{margin})")
    latest = {margin: 0 for margin in MARGINS}
    for number in range(1, rounds + 1):
        for margin in MARGINS:
            others = [m for m in MARGINS if m != margin]
            joins = " ".join(f"JOIN f_{m}_{latest[m]} x_{m} USING ({m})" for m in others)
            product = " * ".join(f"x_{m}.factor" for m in others)
            steps.append(
                f"f_{margin}_{number} AS MATERIALIZED (SELECT {margin}, any_value(target) / sum(tokens * {product}) AS factor "
                f"FROM cells {joins} JOIN t_{margin} USING ({margin}) GROUP BY {margin})"
            )
            latest[margin] = number
    joins = " ".join(f"JOIN f_{m}_{latest[m]} x_{m} USING ({m})" for m in MARGINS)
    product = " * ".join(f"x_{m}.factor" for m in MARGINS)
    steps.append(f"rates AS MATERIALIZED (SELECT source, lang, topic, tokens, {product} AS rate FROM cells {joins})")
    steps.append("s_0 AS (SELECT 0.0::DOUBLE AS scale)")
    for number in range(1, scalings + 1):
        steps.append(
            f"s_{number} AS MATERIALIZED (SELECT ({BUDGET} * sum(tokens) - coalesce(sum(tokens) FILTER (rate * scale >= 1), 0)) "
            f"/ sum(tokens * rate) FILTER (rate * scale < 1) AS scale FROM rates, s_{number - 1})"
        )
    last = f"""drawn AS (
    SELECT doc_id, topic, n_tokens, coalesce(least(1.0, rate * scale), 1.0) AS p
    FROM docs LEFT JOIN (SELECT * FROM rates, s_{scalings}) USING (source, lang, topic)
)
SELECT doc_id, topic, n_tokens, round(p, 6) AS probability,
       ('0x' || substr(md5('{SEED}:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < p AS sampled
FROM drawn"""
    return "WITH " + ",\n".join([*steps, last])


OP10_SQL = _oracle()

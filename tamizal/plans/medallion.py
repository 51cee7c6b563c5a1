"""Bronze text to Silver tables, quality evidence and a published warehouse, end to end."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.operators import constraints, quality
from tamizal.plans import gold
from tamizal.plans.entities import ENTITIES, levels, with_parents
from tamizal.session import materialize, scratch_run, side_by_side, tune
from tamizal.sources.bronze import land_batch, read_bronze
from tamizal.sources.publish import name_current, publish, write_version
from tamizal.sources.schemas import WAREHOUSE, WAREHOUSE_CONSTRAINTS, conform


# the fact in day folders, sorted by experiment: date ranges read only their days
FACT_FOLDERS = {"fact_metricas_experimentos": (["fecha_key"], ["experimento_key", "metrica_key"])}


def evaluate_in_order(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    names: Iterable[str],
    store: Callable[[str, DataFrame], DataFrame] | None = None,
    seen: Callable[[str], DataFrame | None] = lambda _: None,
    known: Callable[[str, DataFrame], DataFrame] = lambda _, df: df,
    columns: dict[str, list[str]] | None = None,
    evidence: bool = True,
) -> dict[str, DataFrame]:
    """Evaluate entities parents first; entities that do not depend on each other run side by side.

    Cleaned rows are written down: every check and every use of the result reads narrow typed columns, and no
    conversion runs twice. With ``columns`` they hold, beside keys and references, only the columns listed for an entity;
    without ``evidence`` the rows as received are left out.

    ``store`` may write an evaluated table and give it back; without it only the accepted keys
    that children look up are written, so no parent is evaluated again for each child. ``known``
    may add the parents accepted by earlier runs.
    """
    names = list(names)
    done: dict[str, DataFrame] = {}
    silver: dict[str, DataFrame] = {}
    used = {r.parent: r.parent_key for n in with_parents(*names) for r in ENTITIES[n].references}

    def one(name: str) -> tuple[DataFrame, DataFrame]:
        parents = {r.parent: silver[r.parent] for r in ENTITIES[name].references}
        wanted = None if columns is None else columns.get(name, [])
        rows = materialize(quality.normalize(read(name), ENTITIES[name], wanted, evidence), f"{name}-rows")
        evaluated = quality.judge(rows, ENTITIES[name], parents, seen(name))
        if store is not None:
            evaluated = store(name, evaluated)
        accepted = known(name, quality.accepted(evaluated))
        if store is None and name in used:
            accepted = materialize(accepted.select(used[name]), f"{name}-keys")
        return evaluated, accepted

    for group in levels(*names):
        for name, (evaluated, accepted) in zip(group, side_by_side(spark, [partial(one, n) for n in group])):
            done[name], silver[name] = evaluated, accepted
    return done


def load_control(evaluated: dict[str, DataFrame], loaded_at: Column) -> DataFrame:
    balance = quality.reconcile(evaluated)
    return conform(balance.withColumns({"estado": F.lit("COMPLETADO"), "cargado_en": loaded_at}), WAREHOUSE["control_cargas"])


def check_warehouse(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> None:
    """Integrity controls at zero, every declared constraint kept, and the expected row counts."""
    quality.require_zero(gold.integrity_controls(tables))
    constraints.require_valid(tables, WAREHOUSE_CONSTRAINTS)
    if expected:
        quality.require_counts(tables, expected)


def run(
    spark: SparkSession,
    incoming: str,
    lake: str,
    batches: list[str],
    version: str,
    expected: dict[str, int] | None = None,
    run_at: Column | None = None,
) -> dict[str, DataFrame]:
    """Land ``batches``, rebuild Silver and quality from Bronze, publish the warehouse as ``version``.

    Bronze is only added to. Derived tables are rebuilt in folders of this run, so a second run gives the
    same rows; Silver, quality and warehouse of the last good run stay current until this one has passed
    its checks, also when it has the same version. Intermediate tables are removed when the run ends.
    """
    tune(spark)
    with scratch_run(spark):
        return _run(spark, incoming, lake, batches, version, expected, run_at)


def _run(spark, incoming, lake, batches, version, expected, run_at) -> dict[str, DataFrame]:
    now = spark.range(1).select(F.current_timestamp()).first()[0] if run_at is None else None
    stamp = F.lit(now) if run_at is None else run_at
    for lote in batches:
        land_batch(spark, incoming, f"{lake}/bronze", lote, ingested_at=stamp)

    evaluated = evaluate_in_order(
        spark,
        lambda e: read_bronze(spark, f"{lake}/bronze", e),
        ENTITIES,
        store=lambda e, df: materialize(df, f"evaluado-{e}"),
    )
    folder, silver = write_version(f"{lake}/silver", version, silver_outputs(evaluated, stamp))
    # the warehouse starts from the written files, not from the plans behind them
    tables = {name: conform(df, WAREHOUSE[name]) for name, df in gold.build({e: silver[e] for e in ENTITIES}).items()}
    tables["control_cargas"] = load_control(evaluated, stamp)
    written = publish(spark, f"{lake}/gold", version, tables, lambda w: check_warehouse(w, expected), FACT_FOLDERS)
    name_current(spark, f"{lake}/silver", version, folder)
    return written


def silver_outputs(evaluated: dict[str, DataFrame], stamp: Column) -> dict[str, DataFrame]:
    """Eight Silver tables and two quality tables."""
    outputs = {e: quality.accepted(df) for e, df in evaluated.items()}
    return {**outputs, "rechazos": quality.rejects(evaluated), "resumen": quality.summary(evaluated, stamp)}

"""Declared constraints checked as one batch job, and deletes that children forbid."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.functions.jsonb import struct_text
from tamizal.session import materialize_all


class ConstraintError(ValueError):
    """Rows that break a declared constraint, or a delete that children forbid."""


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    kind = "NOT NULL"

    @property
    def name(self) -> str:
        return f"{self.table}_{self.column}_not_null"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def entries(self) -> list[Column]:
        return [_entry(self, F.col(self.column).isNull(), None)]


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]
    primary: bool = False

    @property
    def kind(self) -> str:
        return "PRIMARY KEY" if self.primary else "UNIQUE"

    @property
    def name(self) -> str:
        return f"{self.table}_pkey" if self.primary else f"{self.table}_{'_'.join(self.columns)}_key"

    def entries(self) -> list[Column]:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])
        absent = [_entry(self, ~present, None)] if self.primary else []
        return [_entry(self, present, self.columns), *absent]


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_column: str = "id"
    kind = "FOREIGN KEY"

    @property
    def name(self) -> str:
        return f"{self.table}_{self.column}_fkey"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def entries(self) -> list[Column]:
        return [_entry(self, F.col(self.column).isNotNull(), (self.column,))]


@dataclass(frozen=True)
class Check:
    """A condition in SQL text; like in SQL, a condition that is NULL passes."""

    table: str
    label: str
    condition: str
    shown: tuple[str, ...]
    kind = "CHECK"

    @property
    def name(self) -> str:
        return f"{self.table}_{self.label}_check"

    @property
    def columns(self) -> tuple[str, ...]:
        return self.shown

    def entries(self) -> list[Column]:
        return [_entry(self, F.coalesce(~F.expr(self.condition), F.lit(False)), self.shown)]


Constraint = NotNull | Unique | ForeignKey | Check


def _entry(rule: Constraint, holds: Column, columns: tuple[str, ...] | None) -> Column:
    """What a row says to a rule: the rule's name and the values it asks for, if it asks this row at all."""
    value = F.lit(None).cast("string") if columns is None else struct_text(*columns)
    # values without their names, so that a reference and the key it refers to are the same text
    bare = F.lit(None).cast("string") if columns is None else struct_text(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    return F.when(holds, F.struct(F.lit(rule.name).alias("restriccion"), value.alias("clave"), bare.alias("valor")))


def _said(rows: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One pass over a table for all its rules: rows per rule and value, added up where they are read."""
    entries = F.array_compact(F.array(*[entry for c in constraints for entry in c.entries()]))
    return rows.select(F.inline(entries)).groupBy("restriccion", "clave", "valor").agg(F.count(F.lit(1)).alias("filas"))


def violations(tables: dict[str, DataFrame], constraints: list[Constraint]) -> DataFrame:
    """Table, constraint, kind, offending key (JSON) and how many rows carry it.

    Every table is read once, whatever the number of its rules: its rows become counts per rule and value, written
    down. Those counts are all that is asked afterwards: repeated keys, and references without a key among the
    counts of the parent. A parent key that no rule names is read for it.
    """
    by_table: dict[str, list[Constraint]] = {}
    for c in constraints:
        by_table.setdefault(c.table, []).append(c)
    said = materialize_all({f"rules-{table}": _said(tables[table], rules) for table, rules in by_table.items()})
    parts = []
    for table, rules in by_table.items():
        counts = said[f"rules-{table}"]
        for kind in (NotNull, Unique, ForeignKey, Check):
            own = [c for c in rules if isinstance(c, kind)]
            if not own:
                continue
            found = counts.where(F.col("restriccion").isin([c.name for c in own]))
            if kind is Unique:
                found = found.where("filas > 1 OR valor IS NULL")
            if kind is ForeignKey:
                found = reduce(DataFrame.unionByName, [_orphans(found, c, tables, by_table, said) for c in own])
            names = F.create_map(*[F.lit(x) for c in own for x in (c.name, c.kind)])
            parts.append(found.select(F.lit(table).alias("tabla"), "restriccion", names[F.col("restriccion")].alias("tipo"), "clave", "filas"))
    return reduce(DataFrame.unionByName, parts)


def _orphans(found: DataFrame, rule: ForeignKey, tables: dict, by_table: dict, said: dict) -> DataFrame:
    """Values of a reference that the parent's keys lack; both sides are distinct values by now."""
    keys = next((c for c in by_table.get(rule.parent, ()) if isinstance(c, Unique) and c.columns == (rule.parent_column,)), None)
    if keys is not None:
        known = said[f"rules-{rule.parent}"].where(F.col("restriccion") == keys.name).select(F.col("valor").alias("_known"))
    else:
        known = tables[rule.parent].select(struct_text(F.col(rule.parent_column).alias("v0")).alias("_known"))
    return found.where(F.col("restriccion") == rule.name).join(known, F.col("valor") == F.col("_known"), "left_anti")


def require_valid(tables: dict[str, DataFrame], constraints: list[Constraint]) -> None:
    found = violations(tables, constraints).limit(20).collect()
    if found:
        raise ConstraintError("; ".join(f"{r['tipo']} {r['restriccion']} {r['clave']} ({r['filas']} rows)" for r in found))


def blocked_deletes(doomed: DataFrame, key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keys to delete that a child still refers to: table, key, rows."""
    parts = []
    for table, (child, column) in children.items():
        used = child.groupBy(F.col(column).alias("_ref")).agg(F.count(F.lit(1)).alias("filas"))
        hit = used.join(doomed.select(F.col(key).alias("_doomed")), F.col("_ref") == F.col("_doomed"), "left_semi")
        parts.append(hit.select(F.lit(table).alias("tabla"), F.col("_ref").alias("clave"), "filas"))
    return reduce(DataFrame.unionByName, parts)


def delete_restricted(df: DataFrame, test, key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Delete the rows that meet ``test`` unless a child refers to one of them."""
    doomed = F.coalesce(test, F.lit(False))
    blocked = blocked_deletes(df.where(doomed), key, children).limit(5).collect()
    if blocked:
        raise ConstraintError("; ".join(f"{r['tabla']} still refers to {r['clave']}" for r in blocked))
    return df.where(~doomed)


def inventory(spark: SparkSession, constraints: list[Constraint]) -> DataFrame:
    """Declared constraints, one row per column: table, name, kind, column, foreign table and column."""
    rows = [
        (c.table, c.name, c.kind, column, getattr(c, "parent", None), getattr(c, "parent_column", None))
        for c in constraints
        for column in c.columns
    ]
    schema = "tabla string, restriccion string, tipo string, columna string, tabla_referida string, columna_referida string"
    return spark.createDataFrame(rows, schema).orderBy("tabla", "tipo", "restriccion")

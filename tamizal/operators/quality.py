"""Row-level quality: clean, find repeats and unknown references, give each row one error code.

The wide rows are never shuffled for a check. A check first reduces to the keys that break it
(keys seen more than once, references without a parent); those few keys are written down, and
the rows meet them in a join that Spark broadcasts when the written size allows and turns into
a sort-merge join with skew splitting when it does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.functions.jsonb import struct_text
from tamizal.session import materialize, materialize_all
from tamizal.sources.records import INVALID

LINEAGE = ["lote_id", "archivo_origen", "numero_fila", "ingerido_en"]
EVIDENCE = "evidencia_original"
CODE = "codigo_error"
_MALFORMED = "_malformed"
_RECEIVED = "_received"
_ABSENT = "_absent"
_RULE = "_rule"

MISSING_REQUIRED = "MISSING_REQUIRED"
DUPLICATE_KEY = "DUPLICATE_KEY"
MALFORMED_RECORD = "MALFORMED_RECORD"


class QualityGateError(RuntimeError):
    """A control did not hold; nothing has been published."""


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    code: str
    parent_key: str = "id"


@dataclass(frozen=True)
class EntitySpec:
    """What a clean row of an entity is. Rules are ordered: the first that fails names the row."""

    name: str
    key: tuple[str, ...]
    columns: dict[str, Callable[[str], Column]]
    required: tuple[str, ...]
    rules: tuple[tuple[str, Callable[[], Column]], ...] = ()
    references: tuple[Reference, ...] = field(default=())

    def __post_init__(self):
        loose = set(self.key) - set(self.required)
        if loose:
            raise ValueError(f"{self.name}: key columns must be required: {sorted(loose)}")


def normalize(raw: DataFrame, spec: EntitySpec, columns: Iterable[str] | None = None, evidence: bool = True) -> DataFrame:
    """Typed columns, lineage, the row as received, and what the row alone tells: ``_absent`` and the first broken rule.

    With ``columns`` only these typed columns are kept beside keys and references; without ``evidence`` the row as
    received is not. A record whose fields do not fit the columns (``registro_invalido``) has no columns, so it takes
    no key, and its evidence is the record itself.
    """
    received = F.when(F.lit(evidence), F.struct(*[F.col(c).cast("string").alias(c) for c in spec.columns])).alias(_RECEIVED)
    if INVALID not in raw.columns:
        typed = [clean(name).alias(name) for name, clean in spec.columns.items()]
        rows = raw.select(*typed, *LINEAGE, received, F.lit(None).cast("string").alias(_MALFORMED))
    else:
        fits = F.col(INVALID).isNull()
        typed = [F.when(fits, clean(name)).alias(name) for name, clean in spec.columns.items()]
        rows = raw.select(*typed, *LINEAGE, received, F.col(INVALID).alias(_MALFORMED))
    absent = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.required])
    rule = F.lit(None).cast("string")
    for label, broken in reversed(spec.rules):
        rule = F.when(broken(), F.lit(label)).otherwise(rule)
    wanted = set(spec.columns if columns is None else columns) | set(spec.key) | {r.column for r in spec.references}
    kept = [c for c in spec.columns if c in wanted]
    return rows.select(*kept, *LINEAGE, _RECEIVED, _MALFORMED, absent.alias(_ABSENT), rule.alias(_RULE))


def _evidence() -> Column:
    record = struct_text(F.col(_MALFORMED).alias(INVALID))
    return F.when(F.col(_RECEIVED).isNull(), F.lit(None)).when(F.col(_MALFORMED).isNotNull(), record).otherwise(struct_text(f"{_RECEIVED}.*"))


def _position() -> Column:
    """Where a row stands; no two rows stand in the same place."""
    return F.struct("lote_id", "numero_fila", "archivo_origen")


def repeated_keys(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys seen more than once, with the position that keeps the key.

    Keys are counted alone (a hash aggregate); positions, which would have to be sorted, only of those that repeat.
    """
    named = [F.col(k).alias(f"_k_{k}") for k in key]
    keyed = rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))
    times = keyed.groupBy(*named).agg(F.count(F.lit(1)).alias("_times")).where(F.col("_times") > 1).drop("_times")
    keys = [f"_k_{k}" for k in key]
    found = keyed.select(*named, _position().alias("_at")).join(materialize(times, "repeated"), keys, "left_semi")
    return found.groupBy(*keys).agg(F.min("_at").alias("_first"))


def unknown_references(rows: DataFrame, reference: Reference, parents: DataFrame, flag: str) -> DataFrame:
    """Values of the reference that no accepted parent has."""
    used = rows.select(F.col(reference.column).alias(f"_v_{flag}")).where(F.col(f"_v_{flag}").isNotNull()).distinct()
    known = parents.select(F.col(reference.parent_key).alias("_known"))
    return used.join(known, used[f"_v_{flag}"] == known["_known"], "left_anti").withColumn(flag, F.lit(True))


def taken_keys(rows: DataFrame, key: tuple[str, ...], seen: DataFrame) -> DataFrame:
    """Keys of ``rows`` that earlier runs already hold."""
    found = rows.select(*key).distinct().join(seen.select(*key), list(key), "left_semi")
    return found.select(*[F.col(k).alias(f"_s_{k}") for k in key], F.lit(True).alias("_seen"))


def evaluate(
    raw: DataFrame,
    spec: EntitySpec,
    parents: dict[str, DataFrame] | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Typed rows plus ``codigo_error``, NULL on accepted rows: ``normalize``, then ``judge``."""
    return judge(normalize(raw, spec), spec, parents, seen)


def judge(
    rows: DataFrame,
    spec: EntitySpec,
    parents: dict[str, DataFrame] | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``normalize`` plus ``codigo_error``. They are read once per check and once per use of the result.

    Repeats are decided before validity: the first position keeps the key even when that row is
    rejected for another reason. ``seen`` holds keys taken by earlier runs.
    """
    name = spec.name

    checks = {f"{name}-repeats": repeated_keys(rows, spec.key)}
    if seen is not None:
        checks[f"{name}-seen"] = taken_keys(rows, spec.key, seen)
    for i, reference in enumerate(spec.references):
        checks[f"{name}-unknown{i}"] = unknown_references(rows, reference, parents[reference.parent], f"_unknown{i}")
    checks = materialize_all(checks)

    def same_key(prefix: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{prefix}{k}") for k in spec.key])

    judged = rows.join(checks[f"{name}-repeats"], same_key("_k_"), "left").drop(*[f"_k_{k}" for k in spec.key])
    repeated = F.col("_first").isNotNull() & (_position() != F.col("_first"))
    if seen is not None:
        judged = judged.join(checks[f"{name}-seen"], same_key("_s_"), "left").drop(*[f"_s_{k}" for k in spec.key])
        repeated = repeated | F.col("_seen").isNotNull()
    flags = []
    for i, reference in enumerate(spec.references):
        flag = f"_unknown{i}"
        judged = judged.join(
            checks[f"{name}-unknown{i}"], F.col(reference.column) == F.col(f"_v_{flag}"), "left"
        ).drop(f"_v_{flag}")
        flags.append((reference.code, flag))

    code = F.when(F.col(_MALFORMED).isNotNull(), F.lit(MALFORMED_RECORD)).when(F.col(_ABSENT), F.lit(MISSING_REQUIRED)).when(repeated, F.lit(DUPLICATE_KEY))
    code = code.when(F.col(_RULE).isNotNull(), F.col(_RULE))
    for label, flag in flags:
        code = code.when(F.col(flag), F.lit(label))
    kept = [c for c in spec.columns if c in rows.columns]
    return judged.select(*kept, *LINEAGE, _evidence().alias(EVIDENCE), code.alias(CODE))


def accepted(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col(CODE).isNull()).drop(CODE, EVIDENCE)


def rejects(evaluated: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows of every entity with code, lineage and evidence."""
    parts = [
        df.where(F.col(CODE).isNotNull()).select(F.lit(name).alias("entidad"), CODE, *LINEAGE, EVIDENCE)
        for name, df in evaluated.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def summary(evaluated: dict[str, DataFrame], processed_at: Column | None = None) -> DataFrame:
    """Rows received, accepted and rejected per entity."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("recibidas"),
            F.count_if(F.col(CODE).isNull()).alias("aceptadas"),
            F.count_if(F.col(CODE).isNotNull()).alias("rechazadas"),
        ).select(F.lit(name).alias("entidad"), "recibidas", "aceptadas", "rechazadas")
        for name, df in evaluated.items()
    ]
    out = reduce(DataFrame.unionByName, parts)
    return out if processed_at is None else out.withColumn("procesado_en", processed_at)


def code_distribution(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy(CODE).agg(F.count(F.lit(1)).alias("cantidad"))


def reject_listing(rejected: DataFrame) -> DataFrame:
    return rejected.select("entidad", CODE, "lote_id", "numero_fila", EVIDENCE).orderBy("entidad", "numero_fila")


def reconcile(evaluated: dict[str, DataFrame]) -> DataFrame:
    """Accepted against rejected rows per batch, in one pass over the evaluated rows of every entity."""
    per_entity = [
        df.groupBy("lote_id").agg(F.count_if(F.col(CODE).isNull()).alias("a"), F.count_if(F.col(CODE).isNotNull()).alias("r"))
        for df in evaluated.values()
    ]
    total = reduce(DataFrame.unionByName, per_entity).groupBy("lote_id").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    return total.select("lote_id", F.col("a").alias("filas_aceptadas"), F.col("r").alias("filas_rechazadas"))


def counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("cantidad")).select(F.lit(n).alias("objeto"), "cantidad") for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def require_counts(frames: dict[str, DataFrame], expected: dict[str, int]) -> dict[str, int]:
    """Raise unless every expected count holds."""
    actual = {r["objeto"]: r["cantidad"] for r in counts({n: frames[n] for n in expected}).collect()}
    wrong = [f"{n}: expected {e}, found {actual[n]}" for n, e in expected.items() if actual[n] != e]
    if wrong:
        raise QualityGateError("; ".join(wrong))
    return actual


def require_zero(controls: DataFrame) -> None:
    """Raise unless every control row (``control``, ``cantidad``) is zero."""
    broken = controls.where(F.col("cantidad") != 0).limit(50).collect()
    if broken:
        raise QualityGateError("; ".join(f"{r['control']}: {r['cantidad']}" for r in broken))


def gate_column(holds: Column, message: str, *values: Column) -> Column:
    """In-plan gate: ``CONTROLES_OK``, or the job fails with the formatted message."""
    return F.when(holds, F.lit("CONTROLES_OK")).otherwise(
        F.raise_error(F.format_string(message, *values)).cast("string")
    )

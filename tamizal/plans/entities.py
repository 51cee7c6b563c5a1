"""The eight entities of the experiment registry: columns, types, keys and ordered rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamizal.functions.cleaning import (
    clean_text,
    safe_boolean,
    safe_date,
    safe_decimal,
    safe_integer,
    safe_timestamp,
    strip_accents,
)
from tamizal.operators.quality import EntitySpec, Reference

# Accepted metric names with their warehouse keys, and those bounded by one.
METRIC_KEYS = {"accuracy": 1, "precision": 2, "recall": 3, "f1_score": 4, "mae": 5, "loss": 6}
RATIO_METRICS = ["accuracy", "precision", "recall", "f1_score"]

INVALID_DATE = "INVALID_DATE"
INVALID_BOOLEAN = "INVALID_BOOLEAN"


def lower_text(name: str) -> Column:
    return F.lower(clean_text(name))


def plain_name(name: str) -> Column:
    return strip_accents(F.lower(clean_text(name)))


def _null(name: str):
    return lambda: F.col(name).isNull()


def _metric_out_of_range() -> Column:
    return (F.col("valor") < 0) | (F.col("nombre").isin(RATIO_METRICS) & (F.col("valor") > 1))


USUARIOS = EntitySpec(
    name="usuarios",
    key=("id",),
    columns={"id": safe_integer, "nombre": clean_text, "email": lower_text, "activo": safe_boolean, "fecha_alta": safe_timestamp},
    required=("id", "nombre", "email"),
    rules=((INVALID_BOOLEAN, _null("activo")), (INVALID_DATE, _null("fecha_alta"))),
)

TIPOS_FUENTE = EntitySpec("tipos_fuente", ("id",), {"id": safe_integer, "nombre": clean_text}, ("id", "nombre"))

TIPOS_MODELO = EntitySpec("tipos_modelo", ("id",), {"id": safe_integer, "nombre": clean_text}, ("id", "nombre"))

DATASETS = EntitySpec(
    name="datasets",
    key=("id",),
    columns={
        "id": safe_integer,
        "usuario_id": safe_integer,
        "nombre": clean_text,
        "tipo_fuente_id": safe_integer,
        "fuente_detalle": clean_text,
        "cantidad_registros": safe_integer,
        "fecha_creacion": safe_timestamp,
    },
    required=("id", "usuario_id", "nombre", "tipo_fuente_id", "cantidad_registros"),
    rules=(
        ("NEGATIVE_QUANTITY", lambda: F.col("cantidad_registros") < 0),
        (INVALID_DATE, _null("fecha_creacion")),
    ),
    references=(
        Reference("usuario_id", "usuarios", "UNKNOWN_USER"),
        Reference("tipo_fuente_id", "tipos_fuente", "UNKNOWN_SOURCE_TYPE"),
    ),
)

MODELOS = EntitySpec(
    name="modelos",
    key=("id",),
    columns={
        "id": safe_integer,
        "usuario_id": safe_integer,
        "nombre": clean_text,
        "tipo_modelo_id": safe_integer,
        "version": lower_text,
        "fecha_creacion": safe_timestamp,
    },
    required=("id", "usuario_id", "nombre", "tipo_modelo_id"),
    rules=((INVALID_DATE, _null("fecha_creacion")),),
    references=(
        Reference("usuario_id", "usuarios", "UNKNOWN_USER"),
        Reference("tipo_modelo_id", "tipos_modelo", "UNKNOWN_MODEL_TYPE"),
    ),
)

EXPERIMENTOS = EntitySpec(
    name="experimentos",
    key=("id",),
    columns={
        "id": safe_integer,
        "dataset_id": safe_integer,
        "nombre": clean_text,
        "descripcion": clean_text,
        "fecha": safe_date,
        "finalizado": safe_boolean,
    },
    required=("id", "dataset_id", "nombre"),
    rules=((INVALID_DATE, _null("fecha")), (INVALID_BOOLEAN, _null("finalizado"))),
    references=(Reference("dataset_id", "datasets", "UNKNOWN_DATASET"),),
)

EXPERIMENTOS_MODELOS = EntitySpec(
    name="experimentos_modelos",
    key=("experimento_id", "modelo_id"),
    columns={
        "experimento_id": safe_integer,
        "modelo_id": safe_integer,
        "parametros": clean_text,
        "resultado": clean_text,
        "parametros_jsonb": clean_text,
    },
    required=("experimento_id", "modelo_id"),
    references=(
        Reference("experimento_id", "experimentos", "UNKNOWN_EXPERIMENT"),
        Reference("modelo_id", "modelos", "UNKNOWN_MODEL"),
    ),
)

METRICAS = EntitySpec(
    name="metricas",
    key=("id",),
    columns={
        "id": safe_integer,
        "experimento_id": safe_integer,
        "nombre": plain_name,
        "valor": safe_decimal,
        "fecha_registro": safe_timestamp,
    },
    required=("id", "experimento_id", "nombre", "valor"),
    rules=(
        (INVALID_DATE, _null("fecha_registro")),
        ("UNKNOWN_METRIC_CATEGORY", lambda: ~F.col("nombre").isin(list(METRIC_KEYS))),
        ("INVALID_RANGE", _metric_out_of_range),
    ),
    references=(Reference("experimento_id", "experimentos", "UNKNOWN_EXPERIMENT"),),
)

# parents come before the entities that refer to them
ENTITIES = {
    e.name: e
    for e in (
        USUARIOS, TIPOS_FUENTE, TIPOS_MODELO, DATASETS, MODELOS, EXPERIMENTOS, EXPERIMENTOS_MODELOS, METRICAS,
    )
}


def with_parents(*names: str) -> list[str]:
    """``names`` and everything they refer to, parents first."""
    needed: set[str] = set()

    def add(name: str) -> None:
        needed.add(name)
        for reference in ENTITIES[name].references:
            add(reference.parent)

    for name in names:
        add(name)
    return [n for n in ENTITIES if n in needed]


def levels(*names: str) -> list[list[str]]:
    """``with_parents`` in groups; the entities of a group refer only to earlier groups."""
    out: list[list[str]] = []
    placed: dict[str, int] = {}
    for name in with_parents(*names):
        depth = max((placed[r.parent] + 1 for r in ENTITIES[name].references), default=0)
        placed[name] = depth
        if depth == len(out):
            out.append([])
        out[depth].append(name)
    return out

"""Table definitions: columns, types, defaults and constraints of the registry and the warehouse."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamizal.operators.constraints import Check, Constraint, ForeignKey, NotNull, Unique

NUMERIC = "decimal(38,10)"


_JSON_NAMES = {"int": "integer", "bigint": "long", "smallint": "short"}


def schema(columns: str) -> T.StructType:
    """``"id int, nombre string"`` as a schema, without a session."""
    out = T.StructType()
    for column in re.split(r",\s+", columns):
        name, kind = column.split(" ")
        out = out.add(name, _JSON_NAMES.get(kind, kind))
    return out


# The registry before and after its two text columns became catalogs.
REGISTRY: dict[str, T.StructType] = {
    "usuarios": schema("id int, nombre string, email string, activo boolean, fecha_alta timestamp_ntz"),
    "tipos_fuente": schema("id int, nombre string"),
    "datasets": schema(
        "id int, usuario_id int, nombre string, tipo_fuente_id int, fuente_detalle string, cantidad_registros int, fecha_creacion timestamp_ntz"
    ),
    "tipos_modelo": schema("id int, nombre string"),
    "modelos": schema("id int, usuario_id int, nombre string, tipo_modelo_id int, version string, fecha_creacion timestamp_ntz"),
    "experimentos": schema("id int, dataset_id int, nombre string, descripcion string, fecha date, finalizado boolean"),
    "experimentos_modelos": schema("experimento_id int, modelo_id int, parametros string, resultado string, parametros_jsonb variant"),
    "metricas": schema(f"id int, experimento_id int, nombre string, valor {NUMERIC}, fecha_registro timestamp_ntz"),
}
FREE_TEXT_REGISTRY: dict[str, T.StructType] = {
    "datasets": schema("id int, usuario_id int, nombre string, fuente string, cantidad_registros int, fecha_creacion timestamp_ntz"),
    "modelos": schema("id int, usuario_id int, nombre string, tipo string, version string, fecha_creacion timestamp_ntz"),
}


def defaults(now: Column | None = None) -> dict[str, dict[str, Column]]:
    """Values for columns left out of an insert; one ``now`` for a whole run."""
    now = F.localtimestamp() if now is None else now
    return {
        "usuarios": {"activo": F.lit(True), "fecha_alta": now},
        "datasets": {"fecha_creacion": now},
        "modelos": {"fecha_creacion": now},
        "experimentos": {"fecha": F.to_date(now), "finalizado": F.lit(False)},
        "metricas": {"fecha_registro": now},
    }


REGISTRY_CONSTRAINTS: list[Constraint] = [
    *(Unique(t, ("id",), primary=True) for t in REGISTRY if t != "experimentos_modelos"),
    Unique("experimentos_modelos", ("experimento_id", "modelo_id"), primary=True),
    NotNull("usuarios", "nombre"),
    NotNull("usuarios", "email"),
    NotNull("usuarios", "activo"),
    Unique("usuarios", ("email",)),
    NotNull("tipos_fuente", "nombre"),
    Unique("tipos_fuente", ("nombre",)),
    NotNull("tipos_modelo", "nombre"),
    Unique("tipos_modelo", ("nombre",)),
    NotNull("datasets", "usuario_id"),
    NotNull("datasets", "nombre"),
    ForeignKey("datasets", "usuario_id", "usuarios"),
    ForeignKey("datasets", "tipo_fuente_id", "tipos_fuente"),
    NotNull("modelos", "usuario_id"),
    NotNull("modelos", "nombre"),
    ForeignKey("modelos", "usuario_id", "usuarios"),
    ForeignKey("modelos", "tipo_modelo_id", "tipos_modelo"),
    NotNull("experimentos", "dataset_id"),
    NotNull("experimentos", "nombre"),
    ForeignKey("experimentos", "dataset_id", "datasets"),
    ForeignKey("experimentos_modelos", "experimento_id", "experimentos"),
    ForeignKey("experimentos_modelos", "modelo_id", "modelos"),
    NotNull("metricas", "experimento_id"),
    NotNull("metricas", "nombre"),
    NotNull("metricas", "valor"),
    Check("metricas", "valor", "valor >= 0", ("id", "valor")),
    ForeignKey("metricas", "experimento_id", "experimentos"),
]

WAREHOUSE: dict[str, T.StructType] = {
    "dim_fecha": schema("fecha_key int, fecha date, anio smallint, mes smallint, dia smallint, trimestre smallint"),
    "dim_usuario": schema("usuario_key bigint, usuario_id_origen bigint, nombre string, email string, activo boolean, fecha_alta timestamp_ntz"),
    "dim_dataset": schema(
        "dataset_key bigint, dataset_id_origen bigint, usuario_key bigint, nombre string, tipo_fuente string, fuente_detalle string, "
        "cantidad_registros bigint, fecha_creacion timestamp_ntz"
    ),
    "dim_experimento": schema(
        "experimento_key bigint, experimento_id_origen bigint, dataset_key bigint, nombre string, descripcion string, fecha date, finalizado boolean"
    ),
    "dim_metrica": schema("metrica_key smallint, nombre string"),
    "dim_modelo": schema(
        "modelo_key bigint, modelo_id_origen bigint, usuario_key bigint, nombre string, tipo_modelo string, version string, fecha_creacion timestamp_ntz"
    ),
    "bridge_experimento_modelo": schema(
        "experimento_key bigint, modelo_key bigint, parametros string, resultado string, parametros_jsonb variant, lote_id string"
    ),
    "fact_metricas_experimentos": schema(
        "metrica_experimento_key bigint, metrica_id_origen bigint, fecha_key int, experimento_key bigint, metrica_key smallint, "
        "valor decimal(18,6), fecha_registro timestamp_ntz, lote_id string, archivo_origen string"
    ),
    "control_cargas": schema("lote_id string, filas_aceptadas bigint, filas_rechazadas bigint, estado string, cargado_en timestamp"),
}

_REQUIRED = {
    "dim_fecha": "fecha anio mes dia trimestre",
    "dim_usuario": "usuario_id_origen nombre email activo fecha_alta",
    "dim_dataset": "dataset_id_origen usuario_key nombre tipo_fuente cantidad_registros fecha_creacion",
    "dim_experimento": "experimento_id_origen dataset_key nombre fecha finalizado",
    "dim_metrica": "nombre",
    "dim_modelo": "modelo_id_origen usuario_key nombre tipo_modelo fecha_creacion",
    "bridge_experimento_modelo": "experimento_key modelo_key lote_id",
    "fact_metricas_experimentos": "metrica_id_origen fecha_key experimento_key metrica_key valor fecha_registro lote_id archivo_origen",
    "control_cargas": "filas_aceptadas filas_rechazadas estado cargado_en",
}
_PRIMARY = {
    "dim_fecha": ("fecha_key",),
    "dim_usuario": ("usuario_key",),
    "dim_dataset": ("dataset_key",),
    "dim_experimento": ("experimento_key",),
    "dim_metrica": ("metrica_key",),
    "dim_modelo": ("modelo_key",),
    "bridge_experimento_modelo": ("experimento_key", "modelo_key"),
    "fact_metricas_experimentos": ("metrica_experimento_key",),
    "control_cargas": ("lote_id",),
}

WAREHOUSE_CONSTRAINTS: list[Constraint] = [
    *(Unique(t, key, primary=True) for t, key in _PRIMARY.items()),
    *(NotNull(t, c) for t, columns in _REQUIRED.items() for c in columns.split()),
    Unique("dim_fecha", ("fecha",)),
    Unique("dim_usuario", ("usuario_id_origen",)),
    Unique("dim_usuario", ("email",)),
    Unique("dim_dataset", ("dataset_id_origen",)),
    Unique("dim_experimento", ("experimento_id_origen",)),
    Unique("dim_metrica", ("nombre",)),
    Unique("dim_modelo", ("modelo_id_origen",)),
    Unique("fact_metricas_experimentos", ("metrica_id_origen",)),
    Unique("fact_metricas_experimentos", ("experimento_key", "metrica_key", "fecha_registro")),
    ForeignKey("dim_dataset", "usuario_key", "dim_usuario", "usuario_key"),
    ForeignKey("dim_experimento", "dataset_key", "dim_dataset", "dataset_key"),
    ForeignKey("dim_modelo", "usuario_key", "dim_usuario", "usuario_key"),
    ForeignKey("bridge_experimento_modelo", "experimento_key", "dim_experimento", "experimento_key"),
    ForeignKey("bridge_experimento_modelo", "modelo_key", "dim_modelo", "modelo_key"),
    ForeignKey("fact_metricas_experimentos", "fecha_key", "dim_fecha", "fecha_key"),
    ForeignKey("fact_metricas_experimentos", "experimento_key", "dim_experimento", "experimento_key"),
    ForeignKey("fact_metricas_experimentos", "metrica_key", "dim_metrica", "metrica_key"),
    Check("dim_fecha", "anio", "anio BETWEEN 2000 AND 2100", ("fecha_key",)),
    Check("dim_fecha", "mes", "mes BETWEEN 1 AND 12", ("fecha_key",)),
    Check("dim_fecha", "dia", "dia BETWEEN 1 AND 31", ("fecha_key",)),
    Check("dim_fecha", "trimestre", "trimestre BETWEEN 1 AND 4", ("fecha_key",)),
    Check("dim_dataset", "cantidad", "cantidad_registros >= 0", ("dataset_key",)),
    Check("dim_metrica", "nombre", "nombre IN ('accuracy', 'precision', 'recall', 'f1_score', 'mae', 'loss')", ("nombre",)),
    Check("fact_metricas_experimentos", "valor", "valor >= 0", ("metrica_experimento_key",)),
    Check("control_cargas", "aceptadas", "filas_aceptadas >= 0", ("lote_id",)),
    Check("control_cargas", "rechazadas", "filas_rechazadas >= 0", ("lote_id",)),
    Check("control_cargas", "estado", "estado IN ('COMPLETADO', 'FALLIDO')", ("lote_id",)),
]


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Columns of ``declared`` in its order and types; a missing one fails the analysis."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


def create_namespaces(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")

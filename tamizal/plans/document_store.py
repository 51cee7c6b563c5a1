"""Experiments as nested documents: built from the registry, and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.functions import arrays, jsonb
from tamizal.operators.nesting import dangling, lookup_unwind, nest, unwind, value_map
from tamizal.operators.ranking import add_rank
from tamizal.operators.relational import exact_mean
from tamizal.operators.views import create_view

# The shape an experiment document must have.
EXPERIMENT_SCHEMA = {
    "bsonType": "object",
    "required": ["_id", "nombre", "fecha", "finalizado", "dataset", "ejecuciones", "metricas"],
    "properties": {
        "_id": {"bsonType": "string"},
        "nombre": {"bsonType": "string", "minLength": 1},
        "fecha": {"bsonType": "date"},
        "finalizado": {"bsonType": "bool"},
        "dataset": {"bsonType": "object", "required": ["dataset_id", "nombre", "propietario"]},
        "ejecuciones": {"bsonType": "array", "minItems": 1},
        "metricas": {"bsonType": "object"},
    },
}


def _code(prefix: str, column: str) -> Column:
    return F.format_string(f"{prefix}-%03d", F.col(column))


def _owner(t: dict[str, DataFrame]) -> DataFrame:
    person = F.struct(F.col("id").alias("usuario_id"), "nombre", "email").alias("propietario")
    return t["usuarios"].select(F.col("id").alias("_owner"), person)


def build_models(t: dict[str, DataFrame]) -> DataFrame:
    kinds = t["tipos_modelo"].select(F.col("id").alias("tipo_modelo_id"), F.col("nombre").alias("tipo"))
    models = t["modelos"].join(kinds, "tipo_modelo_id").join(_owner(t), F.col("usuario_id") == F.col("_owner"))
    return models.select(_code("mod", "id").alias("_id"), F.col("id").alias("origen_id"), "nombre", "tipo", "version", "propietario")


def build_experiments(t: dict[str, DataFrame]) -> DataFrame:
    """One document per experiment: dataset with its owner, the runs with a snapshot of their model, the metrics."""
    kinds = t["tipos_fuente"].select(F.col("id").alias("tipo_fuente_id"), F.col("nombre").alias("tipo_fuente"))
    dataset = F.struct(
        F.col("id").alias("dataset_id"), "nombre", "tipo_fuente", "fuente_detalle", "cantidad_registros", "propietario"
    ).alias("dataset")
    datasets = (
        t["datasets"].join(kinds, "tipo_fuente_id").join(_owner(t), F.col("usuario_id") == F.col("_owner"))
        .select(F.col("id").alias("_dataset"), dataset)
    )
    model_kinds = t["tipos_modelo"].select(F.col("id").alias("tipo_modelo_id"), F.col("nombre").alias("tipo_modelo"))
    models = t["modelos"].join(model_kinds, "tipo_modelo_id").select(
        F.col("id").alias("_model"), F.col("nombre").alias("modelo_nombre"), "tipo_modelo"
    )
    runs = (
        t["experimentos_modelos"].join(models, F.col("modelo_id") == F.col("_model"))
        .select(
            F.col("experimento_id").alias("_experiment"), _code("mod", "modelo_id").alias("modelo_id"), "modelo_nombre",
            "tipo_modelo", F.to_json("parametros_jsonb").alias("parametros"), "resultado",
        )
    )
    fields = ["modelo_id", "modelo_nombre", "tipo_modelo", "parametros", "resultado"]
    nested = nest(runs, ["_experiment"], fields, "ejecuciones", ["modelo_id"])
    parsed = F.transform(
        "ejecuciones", lambda x: F.struct(*[(jsonb.parse(x[f]) if f == "parametros" else x[f]).alias(f) for f in fields])
    )
    measured = t["metricas"].select(F.col("experimento_id").alias("_measured"), "nombre", F.col("valor").cast("double").alias("v"), "id")
    metrics = value_map(measured, ["_measured"], "nombre", "v", "metricas", "id")
    return (
        t["experimentos"]
        .join(datasets, F.col("dataset_id") == F.col("_dataset"))
        .join(nested, F.col("id") == F.col("_experiment"), "left")
        .join(metrics, F.col("id") == F.col("_measured"), "left")
        .select(
            _code("exp", "id").alias("_id"), F.col("id").alias("origen_id"), "nombre", "descripcion",
            F.col("fecha").cast("timestamp_ntz").alias("fecha"), "finalizado", "dataset", parsed.alias("ejecuciones"), "metricas",
        )
    )


def metric(name: str) -> Column:
    return F.col("metricas")[name]


def has_metric(name: str) -> Column:
    return F.coalesce(F.map_contains_key("metricas", name), F.lit(False))


def run_parameter(run: Column, name: str, kind: str = "string") -> Column:
    return jsonb.field(run["parametros"], name, kind=kind)


def find_one(documents: DataFrame, key: str) -> DataFrame:
    return documents.where(F.col("_id") == key).limit(1)


def reading_view(documents: DataFrame) -> DataFrame:
    rows = documents.select(
        F.col("nombre").alias("experimento"), F.col("dataset.nombre").alias("dataset"),
        F.col("dataset.propietario.nombre").alias("usuario"), "finalizado",
    )
    return create_view(rows, "vw_experimentos_lectura").orderBy("usuario", "dataset", "experimento")


def pending(documents: DataFrame) -> DataFrame:
    return documents.where(~F.col("finalizado")).select("_id", "nombre", "fecha").orderBy("fecha", "_id")


def pending_detail(documents: DataFrame) -> DataFrame:
    return documents.where(~F.col("finalizado")).select(
        F.col("nombre").alias("experimento"), F.col("dataset.nombre").alias("dataset"),
        F.col("dataset.propietario.nombre").alias("propietario"), F.col("ejecuciones.modelo_nombre").alias("modelos"),
    ).orderBy("experimento")


def by_source_type(documents: DataFrame, kind: str) -> DataFrame:
    """Inclusive projection that keeps the nesting."""
    inner = F.struct("dataset.nombre", "dataset.cantidad_registros").alias("dataset")
    return documents.where(F.col("dataset.tipo_fuente") == kind).select("_id", "nombre", inner)


def runs_of_model(documents: DataFrame, model: str) -> DataFrame:
    """Documents that ran a model, with only the first such run."""
    test = lambda x: x["modelo_id"] == model
    return documents.where(arrays.any_element("ejecuciones", test)).select(
        "_id", "nombre", arrays.first_match("ejecuciones", test).alias("ejecuciones")
    )


def runs_with(documents: DataFrame, test) -> DataFrame:
    """Documents where one run meets ``test``, with the first run that does."""
    return documents.where(arrays.any_element("ejecuciones", test)).select(
        "_id", "nombre", arrays.first_match("ejecuciones", test).alias("ejecuciones")
    )


def with_metric(documents: DataFrame, name: str, at_least: float | None = None) -> DataFrame:
    rows = documents.where(has_metric(name)).select("_id", "nombre", metric(name).alias(name))
    return rows if at_least is None else rows.where(F.col(name) >= at_least).orderBy(F.desc(name))


def expand_runs(documents: DataFrame) -> DataFrame:
    rows = unwind(documents.select(F.col("nombre").alias("experimento"), "ejecuciones"), "ejecuciones", "x")
    return rows.select("experimento", F.col("x.modelo_id").alias("modelo_id"), F.col("x.parametros").alias("parametros")).orderBy("experimento", "modelo_id")


def current_models(documents: DataFrame, models: DataFrame, key: str) -> DataFrame:
    """The runs of one experiment with the model as it is today beside the snapshot of then."""
    runs = unwind(documents.where(F.col("_id") == key).select(F.col("nombre").alias("experimento"), "ejecuciones"), "ejecuciones", "x")
    today = models.select(F.col("_id").alias("modelo_id"), F.col("version").alias("version_actual"), F.col("propietario.nombre").alias("propietario"))
    joined = lookup_unwind(runs, today, F.col("x.modelo_id") == F.col("modelo_id"))
    return joined.select("experimento", F.col("x.modelo_nombre").alias("snapshot"), "modelo_id", "version_actual", "propietario")


def dangling_runs(documents: DataFrame, models: DataFrame) -> DataFrame:
    return dangling(documents, "ejecuciones", "modelo_id", models, "_id")


def mean_by_source_type(documents: DataFrame, name: str = "accuracy") -> DataFrame:
    rows = documents.where(has_metric(name)).select(F.col("dataset.tipo_fuente").alias("tipo_fuente"), metric(name).alias("v"))
    return rows.groupBy("tipo_fuente").agg(F.count(F.lit(1)).alias("experimentos"), exact_mean("v").alias(f"{name}_promedio")).orderBy(F.desc(f"{name}_promedio"))


def owners_with_minimum(documents: DataFrame, name: str = "accuracy", at_least: int = 2) -> DataFrame:
    rows = documents.where(has_metric(name)).select("_id", F.col("dataset.propietario").alias("p"), metric(name).alias("v"))
    grouped = rows.groupBy("p.usuario_id").agg(
        F.min_by("p.nombre", "_id").alias("propietario"), F.count(F.lit(1)).alias("cantidad"), exact_mean("v").alias(f"{name}_promedio")
    )
    return grouped.where(F.col("cantidad") >= at_least).drop("usuario_id").orderBy(F.desc(f"{name}_promedio"))


def rank_by_model_type(documents: DataFrame, name: str = "accuracy") -> DataFrame:
    rows = unwind(documents.where(has_metric(name)).select(F.col("nombre").alias("experimento"), metric(name).alias(name), "ejecuciones"), "ejecuciones", "x")
    flat = rows.select(F.col("x.tipo_modelo").alias("tipo_modelo"), F.col("x.modelo_nombre").alias("modelo"), "experimento", name)
    return add_rank(flat, ["tipo_modelo"], [(name, "desc")], rank="posicion").orderBy("tipo_modelo", "posicion")


def metric_difference(documents: DataFrame, first: str = "precision", second: str = "recall") -> DataFrame:
    rows = documents.where(has_metric(first) & has_metric(second))
    return rows.select("_id", "nombre", metric(first).alias(first), metric(second).alias(second), (metric(first) - metric(second)).alias("diferencia")).orderBy(F.desc("diferencia"))

"""Questions asked of the experiment registry: ``t`` holds its eight tables by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.functions import jsonb
from tamizal.operators.ranking import add_rank, add_row_number, top_k, with_group_value
from tamizal.operators.relational import count_children, exact_mean, rounded_mean
from tamizal.operators.views import create_view

Tables = dict[str, DataFrame]


def _renamed(t: Tables, table: str, prefix: str, *columns: str) -> DataFrame:
    """``id`` and the chosen columns of a table, ``id`` and ``nombre`` named after ``prefix``."""
    fixed = {"id": f"{prefix}_id", "nombre": prefix}
    return t[table].select(*[F.col(c).alias(fixed.get(c, c)) for c in ("id", *columns)])


def _users(t: Tables) -> DataFrame:
    return _renamed(t, "usuarios", "usuario", "nombre", "email")


def _datasets(t: Tables) -> DataFrame:
    kinds = _renamed(t, "tipos_fuente", "tipo_fuente", "nombre")
    columns = ("nombre", "usuario_id", "tipo_fuente_id", "fuente_detalle", "cantidad_registros")
    return _renamed(t, "datasets", "dataset", *columns).join(kinds, "tipo_fuente_id").drop("tipo_fuente_id")


def _models(t: Tables) -> DataFrame:
    kinds = _renamed(t, "tipos_modelo", "tipo_modelo", "nombre")
    models = _renamed(t, "modelos", "modelo", "nombre", "tipo_modelo_id", "version")
    return models.join(kinds, "tipo_modelo_id").drop("tipo_modelo_id")


def _experiments(t: Tables) -> DataFrame:
    return _renamed(t, "experimentos", "experimento", "nombre", "dataset_id", "fecha", "finalizado")


def _metrics(t: Tables, name: str | None = None) -> DataFrame:
    rows = t["metricas"].select("experimento_id", F.col("nombre").alias("metrica"), "valor", "fecha_registro", F.col("id").alias("metrica_id"))
    return rows if name is None else rows.where(F.col("metrica") == name)


# --------------------------------------------------------------------------------- joins


def datasets_by_user(t: Tables) -> DataFrame:
    return _users(t).join(_datasets(t), "usuario_id").orderBy("usuario", "dataset")


def experiments_by_dataset(t: Tables) -> DataFrame:
    return _datasets(t).join(_experiments(t), "dataset_id").drop("usuario_id", "cantidad_registros").orderBy("dataset", "fecha")


def models_by_experiment(t: Tables) -> DataFrame:
    runs = t["experimentos_modelos"].select("experimento_id", "modelo_id", "parametros", "resultado")
    joined = runs.join(_experiments(t).select("experimento_id", "experimento"), "experimento_id").join(_models(t), "modelo_id")
    return joined.orderBy("experimento", "modelo")


def metrics_by_experiment(t: Tables) -> DataFrame:
    experiments = _experiments(t).select("experimento_id", "experimento", "finalizado")
    return experiments.join(_metrics(t).drop("metrica_id"), "experimento_id").orderBy("experimento", "metrica")


def full_path(t: Tables) -> DataFrame:
    """User to metric through every table; a metric appears once per participating model.

    Owners and models are joined to the smaller tables first; metrics then meet both on the
    experiment alone.
    """
    context = _experiments(t).join(_datasets(t), "dataset_id").join(_users(t), "usuario_id")
    runs = t["experimentos_modelos"].select("experimento_id", "modelo_id", "parametros", "resultado").join(_models(t), "modelo_id")
    return (
        _metrics(t)
        .drop("metrica_id", "fecha_registro")
        .join(runs, "experimento_id")
        .join(context, "experimento_id")
        .select(
            "usuario", "email", "dataset", "tipo_fuente", "experimento", "fecha", "finalizado", "modelo", "tipo_modelo",
            "parametros", "resultado", "metrica", "valor",
        )
        .orderBy("usuario", "dataset", "experimento", "modelo", "metrica")
    )


def users_without_datasets(t: Tables) -> DataFrame:
    return _users(t).join(t["datasets"].select("usuario_id"), "usuario_id", "left_anti").orderBy("usuario")


def datasets_without_experiments(t: Tables) -> DataFrame:
    datasets = _renamed(t, "datasets", "dataset", "nombre", "fuente_detalle")
    return datasets.join(t["experimentos"].select("dataset_id"), "dataset_id", "left_anti").orderBy("dataset")


# ---------------------------------------------------------------------------- aggregates


def datasets_per_user(t: Tables) -> DataFrame:
    users = _renamed(t, "usuarios", "usuario", "nombre")
    counted = count_children(users, t["datasets"], "usuario_id", "usuario_id", "cantidad_datasets")
    return counted.orderBy(F.desc("cantidad_datasets"), "usuario")


def experiments_per_dataset(t: Tables, at_least: int = 0) -> DataFrame:
    datasets = _renamed(t, "datasets", "dataset", "nombre")
    counted = count_children(datasets, t["experimentos"], "dataset_id", "dataset_id", "cantidad_experimentos")
    return counted.where(F.col("cantidad_experimentos") >= at_least).orderBy(F.desc("cantidad_experimentos"), "dataset")


def datasets_of_users_with_counts(t: Tables) -> DataFrame:
    owned = _renamed(t, "datasets", "dataset", "nombre", "usuario_id").join(_renamed(t, "usuarios", "usuario", "nombre"), "usuario_id")
    counted = count_children(owned, t["experimentos"], "dataset_id", "dataset_id", "cantidad_experimentos")
    return counted.select("usuario", "dataset", "cantidad_experimentos").orderBy("usuario", "dataset")


def metric_statistics(t: Tables) -> DataFrame:
    return (
        _metrics(t)
        .groupBy("metrica")
        .agg(
            exact_mean("valor").alias("promedio"),
            F.min("valor").alias("minimo"),
            F.max("valor").alias("maximo"),
            F.count(F.lit(1)).alias("cantidad_registros"),
        )
        .orderBy("metrica")
    )


def metric_by_model(t: Tables, name: str = "accuracy") -> DataFrame:
    """Mean of a metric per participating model; a metric counts for each model of its experiment."""
    runs = t["experimentos_modelos"].select("experimento_id", "modelo_id")
    per_model = runs.join(_metrics(t, name), "experimento_id").groupBy("modelo_id").agg(
        exact_mean("valor").alias(f"{name}_promedio"), F.count("metrica_id").alias("cantidad")
    )
    return per_model.join(_models(t).drop("version"), "modelo_id").orderBy(F.desc(f"{name}_promedio"), "modelo_id")


def datasets_by_size(t: Tables) -> DataFrame:
    return t["datasets"].select(F.col("nombre").alias("dataset"), "fuente_detalle", "cantidad_registros").orderBy(
        F.desc_nulls_last("cantidad_registros")
    )


def mean_by_date_and_metric(t: Tables) -> DataFrame:
    return _metrics(t).groupBy(F.to_date("fecha_registro").alias("fecha"), "metrica").agg(
        rounded_mean("valor").alias("promedio"), F.count(F.lit(1)).alias("mediciones")
    )


# ------------------------------------------------------------------ subqueries, windows


def metrics_above_mean(t: Tables, name: str = "accuracy") -> DataFrame:
    chosen = _metrics(t, name)
    mean = chosen.select(F.avg("valor")).scalar()
    return chosen.where(F.col("valor") > mean).drop("fecha_registro").orderBy(F.desc("valor"), "metrica_id")


def models_used(t: Tables) -> DataFrame:
    return _models(t).join(t["experimentos_modelos"].select("modelo_id"), "modelo_id", "left_semi").orderBy("modelo")


def models_in_finished_experiments(t: Tables) -> DataFrame:
    finished = _experiments(t).where("finalizado").select("experimento_id", "experimento")
    runs = t["experimentos_modelos"].select("experimento_id", "modelo_id").join(finished, "experimento_id")
    return runs.join(_models(t), "modelo_id").select("modelo", "tipo_modelo", "experimento").distinct().orderBy("modelo")


def metric_positions(t: Tables) -> DataFrame:
    rows = add_row_number(_metrics(t), ["metrica"], [("valor", "desc")], ["metrica_id"], "posicion_en_su_metrica")
    return rows.select("metrica", "experimento_id", "valor", "posicion_en_su_metrica").orderBy("metrica", "posicion_en_su_metrica")


def metric_against_mean(t: Tables) -> DataFrame:
    rows = with_group_value(_metrics(t), ["metrica"], promedio_de_la_metrica=exact_mean("valor"))
    difference = (F.col("valor").cast("double") - F.col("promedio_de_la_metrica")).alias("diferencia_vs_promedio")
    return rows.select("metrica", "experimento_id", "valor", "promedio_de_la_metrica", difference).orderBy("metrica", F.desc("valor"))


def _model_values(t: Tables, name: str) -> DataFrame:
    runs = t["experimentos_modelos"].select("experimento_id", "modelo_id")
    return runs.join(_metrics(t, name), "experimento_id").join(_models(t), "modelo_id").join(
        _experiments(t).select("experimento_id", "experimento"), "experimento_id"
    )


def metric_dense_rank(t: Tables, name: str = "accuracy") -> DataFrame:
    ranked = add_rank(_model_values(t, name), [], [("valor", "desc")], rank=None, dense_rank="ranking")
    return ranked.select("modelo", "tipo_modelo", "experimento", F.col("valor").alias(name), "ranking").orderBy("ranking", "modelo")


def model_ranking(t: Tables, name: str = "accuracy") -> DataFrame:
    ranked = add_row_number(_model_values(t, name), [], [("valor", "desc")], ["experimento_id", "modelo_id"], "ranking")
    return ranked.select("modelo", "metrica", "valor", "ranking").orderBy("ranking")


def best_metric(t: Tables, name: str = "accuracy", k: int = 1) -> DataFrame:
    """The ``k`` best values with their experiment; only those are joined."""
    best = top_k(_metrics(t, name), [("valor", "desc"), ("metrica_id", "asc")], k)
    return best.join(_experiments(t).select("experimento_id", "experimento"), "experimento_id").select("experimento", F.col("valor").alias(name))


# --------------------------------------------------------------------------------- views


def experiment_summary(t: Tables) -> DataFrame:
    rows = _experiments(t).join(_datasets(t).drop("cantidad_registros"), "dataset_id").join(_users(t), "usuario_id")
    return create_view(rows, "vw_experimentos_resumen")


def experiment_model_summary(t: Tables) -> DataFrame:
    datasets = _renamed(t, "datasets", "dataset", "nombre")
    runs = t["experimentos_modelos"].select("experimento_id", "modelo_id", "parametros", "resultado")
    rows = (
        runs.join(_experiments(t).select("experimento_id", "experimento", "dataset_id"), "experimento_id")
        .join(datasets, "dataset_id")
        .join(_models(t).drop("version"), "modelo_id")
        .select("experimento_id", "experimento", "dataset", "modelo_id", "modelo", "tipo_modelo", "parametros", "resultado")
    )
    return create_view(rows, "vw_experimentos_modelos_resumen")


def full_case_view(t: Tables) -> DataFrame:
    return create_view(full_path(t).select("usuario", "dataset", "experimento", "modelo", "metrica", "valor"), "vw_caso_guia_completo")


# ---------------------------------------------------------------------------------- JSON


def _runs(t: Tables, *more: str | Column) -> DataFrame:
    return t["experimentos_modelos"].select("experimento_id", "modelo_id", "parametros_jsonb", *more)


def parameter(t: Tables, name: str) -> DataFrame:
    """Runs that set a parameter, with its value as text."""
    value = jsonb.field("parametros_jsonb", name).alias(name)
    return _runs(t, value).where(F.col(name).isNotNull()).drop("parametros_jsonb")


def runs_with_parameter(t: Tables, name: str) -> DataFrame:
    return _runs(t).where(jsonb.has_key(F.to_json("parametros_jsonb"), name))


def runs_containing(t: Tables, fragment: str | dict) -> DataFrame:
    return _runs(t).where(jsonb.contains("parametros_jsonb", fragment))

"""Warehouse tables from accepted rows: six dimensions, one bridge, one fact, load control."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.functions.calendar import calendar_columns, date_key
from tamizal.functions.jsonb import parse
from tamizal.operators.nesting import nest
from tamizal.operators.relational import quotient
from tamizal.plans.entities import METRIC_KEYS


def metric_key(name: str) -> Column:
    """Stable key of a known metric name; the catalog is fixed, so it is a map inside the plan."""
    pairs = [F.lit(x) for item in METRIC_KEYS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(name)).cast("smallint")


def dim_fecha(experimentos: DataFrame, metricas: DataFrame) -> DataFrame:
    days = experimentos.select("fecha").union(metricas.select(F.to_date("fecha_registro").alias("fecha")))
    return days.distinct().select(*calendar_columns("fecha"))


def dim_usuario(usuarios: DataFrame) -> DataFrame:
    return usuarios.select(
        F.col("id").alias("usuario_key"), F.col("id").alias("usuario_id_origen"), "nombre", "email", "activo", "fecha_alta"
    )


def dim_dataset(datasets: DataFrame, tipos_fuente: DataFrame) -> DataFrame:
    kinds = tipos_fuente.select(F.col("id").alias("tipo_fuente_id"), F.col("nombre").alias("tipo_fuente"))
    return datasets.join(kinds, "tipo_fuente_id").select(
        F.col("id").alias("dataset_key"),
        F.col("id").alias("dataset_id_origen"),
        F.col("usuario_id").alias("usuario_key"),
        "nombre",
        "tipo_fuente",
        "fuente_detalle",
        "cantidad_registros",
        "fecha_creacion",
    )


def dim_experimento(experimentos: DataFrame) -> DataFrame:
    return experimentos.select(
        F.col("id").alias("experimento_key"),
        F.col("id").alias("experimento_id_origen"),
        F.col("dataset_id").alias("dataset_key"),
        "nombre",
        "descripcion",
        "fecha",
        "finalizado",
    )


def dim_metrica(metricas: DataFrame) -> DataFrame:
    return metricas.select("nombre").distinct().select(metric_key("nombre").alias("metrica_key"), "nombre")


def dim_modelo(modelos: DataFrame, tipos_modelo: DataFrame) -> DataFrame:
    kinds = tipos_modelo.select(F.col("id").alias("tipo_modelo_id"), F.col("nombre").alias("tipo_modelo"))
    return modelos.join(kinds, "tipo_modelo_id").select(
        F.col("id").alias("modelo_key"),
        F.col("id").alias("modelo_id_origen"),
        F.col("usuario_id").alias("usuario_key"),
        "nombre",
        "tipo_modelo",
        "version",
        "fecha_creacion",
    )


def bridge_experimento_modelo(experimentos_modelos: DataFrame) -> DataFrame:
    """Participation of models in experiments; it stays apart from the fact, which it would multiply."""
    return experimentos_modelos.select(
        F.col("experimento_id").alias("experimento_key"),
        F.col("modelo_id").alias("modelo_key"),
        "parametros",
        "resultado",
        parse("parametros_jsonb").alias("parametros_jsonb"),
        "lote_id",
    )


def fact_metricas_experimentos(metricas: DataFrame) -> DataFrame:
    """One metric of one experiment at one instant."""
    return metricas.select(
        F.col("id").alias("metrica_experimento_key"),
        F.col("id").alias("metrica_id_origen"),
        date_key("fecha_registro").alias("fecha_key"),
        F.col("experimento_id").alias("experimento_key"),
        metric_key("nombre").alias("metrica_key"),
        "valor",
        "fecha_registro",
        "lote_id",
        "archivo_origen",
    )


def build(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_fecha": dim_fecha(silver["experimentos"], silver["metricas"]),
        "dim_usuario": dim_usuario(silver["usuarios"]),
        "dim_dataset": dim_dataset(silver["datasets"], silver["tipos_fuente"]),
        "dim_experimento": dim_experimento(silver["experimentos"]),
        "dim_metrica": dim_metrica(silver["metricas"]),
        "dim_modelo": dim_modelo(silver["modelos"], silver["tipos_modelo"]),
        "bridge_experimento_modelo": bridge_experimento_modelo(silver["experimentos_modelos"]),
        "fact_metricas_experimentos": fact_metricas_experimentos(silver["metricas"]),
    }


def integrity_controls(gold: dict[str, DataFrame]) -> DataFrame:
    """Facts without experiment, bridge rows without model, facts repeated at their grain."""

    def counted(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("cantidad")).select(F.lit(label).alias("control"), "cantidad")

    fact, bridge = gold["fact_metricas_experimentos"], gold["bridge_experimento_modelo"]
    grain = ["experimento_key", "metrica_key", "fecha_registro"]
    repeated = fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return reduce(
        DataFrame.unionByName,
        [
            counted("hechos_sin_experimento", fact.join(gold["dim_experimento"], "experimento_key", "left_anti")),
            counted("puentes_sin_modelo", bridge.select("modelo_key").join(gold["dim_modelo"], "modelo_key", "left_anti")),
            counted("duplicados_hecho", repeated),
        ],
    )


def mean_by_date_and_metric(gold: dict[str, DataFrame]) -> DataFrame:
    """Mean and number of measurements per date and metric.

    The fact is reduced on its own keys first; the dimensions only name what is left.
    """
    reduced = gold["fact_metricas_experimentos"].groupBy("fecha_key", "metrica_key").agg(
        F.sum("valor").alias("total"), F.count(F.lit(1)).alias("mediciones")
    )
    return (
        reduced.join(gold["dim_fecha"].select("fecha_key", "fecha"), "fecha_key")
        .join(gold["dim_metrica"].select("metrica_key", F.col("nombre").alias("metrica")), "metrica_key")
        .select("fecha", "metrica", quotient(F.col("total"), F.col("mediciones")).alias("promedio"), "mediciones")
        .orderBy("fecha", "metrica")
    )


def accuracy_by_owner(gold: dict[str, DataFrame], metric: str = "accuracy") -> DataFrame:
    """Mean of a metric per dataset and dataset owner, along fact, experiment, dataset, user."""
    wanted = gold["dim_metrica"].where(F.col("nombre") == metric).select("metrica_key")
    per_experiment = (
        gold["fact_metricas_experimentos"]
        .join(wanted, "metrica_key", "left_semi")
        .groupBy("experimento_key")
        .agg(F.sum("valor").alias("total"), F.count(F.lit(1)).alias("n"))
    )
    datasets = gold["dim_dataset"].select("dataset_key", "usuario_key", F.col("nombre").alias("dataset"))
    owners = gold["dim_usuario"].select("usuario_key", F.col("nombre").alias("propietario"))
    return (
        per_experiment.join(gold["dim_experimento"].select("experimento_key", "dataset_key"), "experimento_key")
        .groupBy("dataset_key")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .join(datasets, "dataset_key")
        .join(owners, "usuario_key")
        .groupBy("propietario", "dataset")
        .agg(quotient(F.sum("total"), F.sum("n")).alias(f"{metric}_promedio"))
        .orderBy(F.desc(f"{metric}_promedio"), "propietario", "dataset")
    )


def models_by_experiment(gold: dict[str, DataFrame]) -> DataFrame:
    """Participating models of each experiment: how many, and their names in order as one text."""
    names = gold["dim_modelo"].select("modelo_key", F.col("nombre").alias("modelo"))
    experiments = gold["dim_experimento"].select("experimento_key", F.col("nombre").alias("experimento"))
    rows = (
        gold["bridge_experimento_modelo"].select("experimento_key", "modelo_key")
        .join(names, "modelo_key")
        .join(experiments, "experimento_key")
        .select("experimento", "modelo", "modelo_key")
    )
    totals = rows.groupBy("experimento").agg(F.count(F.lit(1)).alias("modelos_participantes"))
    listed = nest(rows, ["experimento"], ["modelo"], "m", ["modelo", "modelo_key"])
    return (
        listed.join(totals, "experimento")
        .select("experimento", "modelos_participantes", F.array_join(F.col("m.modelo"), ", ").alias("modelos"))
        .orderBy(F.desc("modelos_participantes"), "experimento")
    )

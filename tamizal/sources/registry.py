"""Clean files of the registry: typed flat tables and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamizal.functions.cleaning import safe_timestamp
from tamizal.sources.schemas import REGISTRY

DATASET = "struct<dataset_id:int, nombre:string, tipo_fuente:string, fuente_detalle:string, cantidad_registros:int, propietario:struct<usuario_id:int, nombre:string, email:string>>"
RUNS = "array<struct<modelo_id:string, modelo_nombre:string, tipo_modelo:string, parametros:variant, resultado:string>>"
EXPERIMENT_DOCUMENT = (
    f"_id string, origen_id int, nombre string, descripcion string, fecha string, finalizado boolean, dataset {DATASET}, ejecuciones {RUNS}, metricas map<string, double>"
)
MODEL_DOCUMENT = "_id string, origen_id int, nombre string, tipo string, version string, propietario struct<usuario_id:int, nombre:string, email:string>"


def _convert(name: str, kind: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, T.VariantType):
        return F.parse_json(text)
    if isinstance(kind, T.BooleanType):
        return text == "true"
    if isinstance(kind, T.TimestampNTZType):
        return safe_timestamp(text)
    return text.cast(kind)


def load_flat(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A clean CSV as the declared table; a value that does not fit fails the job."""
    declared = REGISTRY[table]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared])
    rows = spark.read.schema(text).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return rows.select(*[_convert(f.name, f.dataType).alias(f.name) for f in declared])


def load_documents(spark: SparkSession, path: str, schema: str = EXPERIMENT_DOCUMENT) -> DataFrame:
    """Documents from JSON, one array per file or one document per line; dates become timestamps."""
    declared = T.StructType.fromDDL(schema)
    documents = spark.read.schema(declared).option("multiLine", True).json(path)
    if "fecha" in declared.names:
        documents = documents.withColumn("fecha", F.col("fecha").cast("timestamp_ntz"))
    return documents


def generate_metrics(spark: SparkSession, rows: int, experiment: int = 1, seed: int = 7) -> DataFrame:
    """Made-up measurements in turn over three names, values in [0.5, 1)."""
    turn = F.col("id") % 3
    name = F.when(turn == 0, "accuracy").when(turn == 1, "precision").otherwise("recall")
    return spark.range(1, rows + 1).select(
        F.lit(experiment).alias("experimento_id"),
        name.alias("nombre"),
        F.round(F.lit(0.5) + F.rand(seed) * 0.5, 4).cast("decimal(38,10)").alias("valor"),
    )

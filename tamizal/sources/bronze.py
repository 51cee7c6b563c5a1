"""Text batches: read as strings with lineage, land once, never overwrite."""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamizal.plans.entities import ENTITIES
from tamizal.session import materialize, side_by_side
from tamizal.sources.records import INVALID, read_records


class LandingError(RuntimeError):
    """A batch that is incomplete, unknown, or half landed."""


def text_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in ENTITIES[entity].columns])


def read_csv(spark: SparkSession, path: str, entity: str, multi_line: bool = False) -> DataFrame:
    """Every column as text, with the file and place each row comes from. ``path`` may be a glob."""
    return (
        spark.read.schema(text_schema(entity))
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .csv(path)
        .withColumn("archivo_origen", F.col("_metadata.file_path"))
        .withColumn("_block", F.col("_metadata.file_block_start"))
        .withColumn("_place", F.monotonically_increasing_id())
    )


def batch_id(path: Column | str) -> Column:
    return F.regexp_extract(path, "lote=([^/]+)", 1)


def with_lineage(rows: DataFrame, ingested_at: Column) -> DataFrame:
    """Batch id, line number in the file (the header is line 1) and ingestion time.

    Rows of a file block keep their order, so a line number is the place inside the block plus
    the rows of the blocks before it. Only blocks are ordered, never the rows of a file.
    ``rows`` are written down first: places must not be recomputed over other splits.
    """
    placed = materialize(rows, "landing")
    blocks = placed.groupBy("archivo_origen", "_block").agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("archivo_origen").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).drop("_n", "_start")
    shifts = materialize(shifts, "blocks")
    return (
        placed.join(shifts, ["archivo_origen", "_block"])
        .withColumn("lote_id", batch_id("archivo_origen"))
        .withColumn("numero_fila", (F.col("_place") + F.col("_shift") + 2).cast("bigint"))
        .withColumn("ingerido_en", ingested_at)
        .drop("_block", "_place", "_shift")
    )


def read_entity(spark: SparkSession, path: str | list[str], entity: str, ingested_at: Column) -> DataFrame:
    """Text rows of CSV files with lineage: quoted line breaks, surplus and missing fields included, in many tasks."""
    rows = read_records(spark, path, list(ENTITIES[entity].columns))
    return rows.withColumns({
        "lote_id": batch_id("archivo_origen"), "numero_fila": F.col("numero_fila").cast("bigint"), "ingerido_en": ingested_at
    })


def read_batches(spark: SparkSession, root: str, entity: str, ingested_at: Column | None = None) -> DataFrame:
    """All batches ``root/lote=*/<entity>.csv`` with lineage."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    return read_entity(spark, f"{root}/lote=*/{entity}.csv", entity, now)


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    """Files under ``path``, by name only, or None when there is no such folder."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    except AnalysisException:
        return None


def landed_batches(spark: SparkSession, bronze: str) -> DataFrame:
    """Ledger of complete batches; its row is the last thing a landing writes."""
    ledger = "lote_id string, entidades int, ingerido_en timestamp"
    if _listed(spark, f"{bronze}/_lotes") is None:
        return spark.createDataFrame([], ledger)
    return spark.read.schema(ledger).parquet(f"{bronze}/_lotes")


def land_batch(
    spark: SparkSession, incoming: str, bronze: str, lote: str, allowed: list[str] | None = None, ingested_at: Column | None = None
) -> bool:
    """Land ``incoming/lote=<lote>`` into the text tables under ``bronze``.

    True when it landed, False when it was there already. A batch that is not allowed, lacks an
    entity, or was left half landed raises, and nothing already landed is touched. So does a file with another
    header or a quote that never closes; a record with surplus or missing fields lands whole, to be rejected.
    """
    if allowed is not None and lote not in allowed:
        raise LandingError(f"batch not allowed: {lote}")
    if not landed_batches(spark, bronze).where(F.col("lote_id") == lote).isEmpty():
        return False
    files = _listed(spark, f"{incoming}/lote={lote}")
    if files is None:
        raise LandingError(f"no such batch: {lote}")
    named = files.select(F.regexp_extract("path", f"lote={lote}/([^/.]+)", 1).alias("entidad")).distinct()
    received = {r["entidad"] for r in named.where(F.col("entidad").isin(list(ENTITIES))).collect()}
    missing = sorted(set(ENTITIES) - received)
    if missing:
        raise LandingError(f"{lote} lacks {missing}")
    half = [e for e in ENTITIES if _listed(spark, f"{bronze}/{e}/lote={lote}") is not None]
    if half:
        raise LandingError(f"{lote} is half landed: {half}")
    now = F.current_timestamp() if ingested_at is None else ingested_at

    def land(entity: str) -> None:
        rows = read_entity(spark, f"{incoming}/lote={lote}/{entity}.csv", entity, now)
        rows.write.mode("errorifexists").option("compression", "zstd").parquet(f"{bronze}/{entity}/lote={lote}")

    side_by_side(spark, [partial(land, entity) for entity in ENTITIES])
    done = spark.range(1).select(
        F.lit(lote).alias("lote_id"), F.lit(len(ENTITIES)).alias("entidades"), F.current_timestamp().alias("ingerido_en")
    )
    done.write.mode("append").parquet(f"{bronze}/_lotes")
    return True


def read_bronze(spark: SparkSession, bronze: str, entity: str) -> DataFrame:
    """Landed text rows of complete batches; the folder of the batch prunes by ``lote``."""
    complete = landed_batches(spark, bronze).select(F.col("lote_id").alias("_complete"))
    columns = [f"`{c}` string" for c in [*ENTITIES[entity].columns, INVALID, "archivo_origen"]]
    schema = ", ".join([*columns, "numero_fila bigint, lote_id string, ingerido_en timestamp, lote string"])
    rows = spark.read.schema(schema).option("basePath", f"{bronze}/{entity}").parquet(f"{bronze}/{entity}")
    return rows.join(complete, F.col("lote") == F.col("_complete"), "left_semi").drop("lote")

"""Batches that arrive file by file: each one waits until it is complete, is judged, and is appended.

The stream carries the names of arriving files. Every trigger writes down what came; a batch is released when
all entities have come, so that children never meet rules before their parents, whatever order files arrive in.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.operators import quality
from tamizal.plans.entities import ENTITIES
from tamizal.plans.medallion import evaluate_in_order
from tamizal.session import scratch_run
from tamizal.sources.bronze import batch_id, read_entity
from tamizal.sources.publish import write_table


_PER_TRIGGER = 1 << 20  # batches that one trigger may release have numbers of their own


def _read_before(spark: SparkSession, path: str, batch: int, until: bool = False) -> DataFrame | None:
    """What triggers before this one wrote (this one too with ``until``); a repeated trigger does not see its own first try."""
    try:
        rows = spark.read.option("basePath", path).parquet(path)
    except AnalysisException:
        return None
    return rows.where(F.col("micro") <= batch if until else F.col("micro") < batch).drop("micro")


def _arrivals(spark: SparkSession, incoming: str) -> DataFrame:
    """Stream of file names; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(incoming)
        .select(F.col("path").alias("archivo"))
        .withColumns({"lote_id": batch_id("archivo"), "entidad": F.regexp_extract("archivo", r"([^/]+)\.csv$", 1)})
    )


def complete_batches(spark: SparkSession, lake: str, batch: int, order: list[str] | None = None) -> list[str]:
    """Batches with a file of every entity that no earlier trigger has released, in their order.

    With ``order`` a batch also waits for all that stand before it there, and others are never released. The
    names of the batches that wait are what the driver reads.
    """
    arrived = _read_before(spark, f"{lake}/_llegadas", batch, until=True)
    if arrived is None:
        return []
    counted = arrived.where(F.col("entidad").isin(list(ENTITIES))).groupBy("lote_id").agg(F.count_distinct("entidad").alias("n"))
    whole = counted.where(F.col("n") == len(ENTITIES)).select("lote_id")
    released = _read_before(spark, f"{lake}/_liberados", batch)
    waiting = whole if released is None else whole.join(released, "lote_id", "left_anti")
    names = sorted(r["lote_id"] for r in waiting.collect())
    if order is None:
        return names
    done = set() if released is None else {r["lote_id"] for r in released.collect()}
    out = []
    for name in order:
        if name in done:
            continue
        if name not in names:
            break
        out.append(name)
    return out


def process_batch(spark: SparkSession, lake: str, name: str, batch: int) -> None:
    """Judge one released batch. Output folders are named by trigger and place in it, so a retry writes the same place."""
    arrived = _read_before(spark, f"{lake}/_llegadas", batch, until=True).where(F.col("lote_id") == name)
    files: dict[str, list[str]] = {e: [] for e in ENTITIES}
    for row in arrived.where(F.col("entidad").isin(list(ENTITIES))).select("entidad", "archivo").distinct().collect():
        files[row["entidad"]].append(row["archivo"])
    now = spark.range(1).select(F.current_timestamp()).first()[0]

    def landed(entity: str) -> DataFrame:
        return write_table(read_entity(spark, sorted(files[entity]), entity, F.lit(now)), f"{lake}/landed/{entity}/micro={batch}")

    def seen(entity: str) -> DataFrame | None:
        return _read_before(spark, f"{lake}/claves/{entity}", batch)

    def store(entity: str, evaluated: DataFrame) -> DataFrame:
        spec = ENTITIES[entity]
        written = write_table(evaluated, f"{lake}/evaluados/{entity}/micro={batch}")
        write_table(quality.accepted(written), f"{lake}/silver/{entity}/micro={batch}")
        keys = written.select(*spec.key).na.drop().distinct()
        write_table(keys, f"{lake}/claves/{entity}/micro={batch}")
        return written

    def known(entity: str, accepted: DataFrame) -> DataFrame:
        earlier = _read_before(spark, f"{lake}/silver/{entity}", batch)
        return accepted if earlier is None else accepted.unionByName(earlier)

    evaluated = evaluate_in_order(spark, landed, ENTITIES, store, seen, known)
    write_table(quality.rejects(evaluated), f"{lake}/calidad/rechazos/micro={batch}")
    write_table(quality.summary(evaluated, F.lit(now)), f"{lake}/calidad/resumen/micro={batch}")


def process_arrivals(spark: SparkSession, lake: str, arrivals: DataFrame, trigger: int, order: list[str] | None = None) -> None:
    """Write down what arrived, and judge what is complete by it, one batch after another."""
    batch = trigger * _PER_TRIGGER
    write_table(arrivals, f"{lake}/_llegadas/micro={batch}")
    names = complete_batches(spark, lake, batch, order)
    for place, name in enumerate(names):
        with scratch_run(spark):
            process_batch(spark, lake, name, batch + place)
    if names:
        # last: a trigger that fails before this releases the same batches again
        write_table(spark.createDataFrame([(n,) for n in names], "lote_id string"), f"{lake}/_liberados/micro={batch}")


def ingest_available(spark: SparkSession, incoming: str, lake: str, order: list[str] | None = None) -> None:
    """Process every file not seen yet, then stop; a second call finds nothing to do.

    ``order`` names the batches that are expected, the first one first: then any order of arrival gives what one
    landing of each in that order gives. Without it batches are judged as they become complete.
    """
    query = (
        _arrivals(spark, incoming)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{lake}/_checkpoint")
        .foreachBatch(lambda arrivals, batch: process_arrivals(spark, lake, arrivals, batch, order))
        .start()
    )
    query.awaitTermination()


def waiting_batches(spark: SparkSession, lake: str) -> DataFrame:
    """Batches that are not released, with the entities that have come."""
    last = 1 << 62
    arrived = _read_before(spark, f"{lake}/_llegadas", last)
    empty = spark.createDataFrame([], "lote_id string, entidades array<string>")
    if arrived is None:
        return empty
    held = arrived.groupBy("lote_id").agg(F.sort_array(F.collect_set("entidad")).alias("entidades"))
    released = _read_before(spark, f"{lake}/_liberados", last)
    return held if released is None else held.join(released, "lote_id", "left_anti")


def read_silver(spark: SparkSession, lake: str, entity: str) -> DataFrame:
    path = f"{lake}/silver/{entity}"
    return spark.read.option("basePath", path).parquet(path).drop("micro")

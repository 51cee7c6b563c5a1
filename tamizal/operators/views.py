"""Named queries: temporary views and stored snapshots that are refreshed on demand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.operators.relational import quotient
from tamizal.sources.publish import publish, read_published, write_table


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


class Snapshot:
    """Stored result of a query. Reads see the last refresh; a refresh replaces it all at once."""

    def __init__(self, spark: SparkSession, path: str, query: Callable[[], DataFrame]):
        self.spark, self.path, self.query = spark, path, query

    def refresh(self) -> DataFrame:
        version = self.spark.range(1).select(F.uuid()).first()[0]
        return publish(self.spark, self.path, version, {"datos": self.query()}, lambda _: None)["datos"]

    def read(self) -> DataFrame:
        return read_published(self.spark, self.path, "datos")


class PartedSnapshot:
    """Stored aggregate that is refreshed by the new batches alone.

    Every batch leaves its partial aggregates (count, exact sum, least and greatest value per group) in a folder of
    its own; reading merges the folders. A batch that is refreshed again replaces its folder, so a retry does no harm.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], value: str, scale: int = 6):
        self.spark, self.path, self.keys, self.value, self.scale = spark, path, keys, value, scale

    def _partial(self, rows: DataFrame) -> DataFrame:
        exact = F.col(self.value).cast(f"decimal(28,{self.scale})")
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("filas"), F.count(self.value).alias("n"), F.sum(exact).alias("total"),
            F.min(self.value).alias("minimo"), F.max(self.value).alias("maximo"),
        )

    def _merged(self) -> DataFrame:
        parts = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/lote=*")
        return parts.groupBy(*self.keys).agg(
            F.sum("filas").alias("filas"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo")
        )

    def refresh(self, batch: str, rows: DataFrame) -> None:
        """Take in the rows of one batch; rows of others are not read."""
        write_table(self._partial(rows), f"{self.path}/lote={batch}")

    def read(self, digits: int = 4) -> DataFrame:
        mean = quotient(F.col("total"), F.nullif(F.col("n"), F.lit(0)), digits)
        return self._merged().select(*self.keys, "filas", mean.alias("promedio"), "minimo", "maximo")

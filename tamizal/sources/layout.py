"""File layouts for the access paths that a database would index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.operators.nesting import unwind


def write_partitioned(df: DataFrame, path: str, by: list[str], sort_by: list[str]) -> None:
    """Folders by value, files sorted inside; a value with most rows is spread over many tasks."""
    ranged = df.repartitionByRange(*by, *sort_by).sortWithinPartitions(*by, *sort_by)
    ranged.write.mode("overwrite").partitionBy(*by).option("compression", "zstd").parquet(path)


def write_sorted(df: DataFrame, path: str, by: list[str]) -> None:
    """Files and row groups with narrow value ranges, which a filter on ``by`` can skip."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_bucketed(df: DataFrame, table: str, by: list[str], buckets: int) -> None:
    """Table clustered by key: joins and groupings on the key need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)


def write_bloom(df: DataFrame, path: str, column: str, expected_distinct: int) -> None:
    """Row groups carry a bloom filter on ``column`` for point lookups."""
    options = {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(expected_distinct),
    }
    df.write.mode("overwrite").options(**options).parquet(path)


def write_time_series(df: DataFrame, path: str, time: str, meta: list[str]) -> None:
    """Series in day folders, sorted by series and time; a range of days reads only its folders."""
    write_partitioned(df.withColumn("fecha_dia", F.to_date(time)), path, ["fecha_dia"], [*meta, time])


def read_time_range(spark, path: str, time: str, start: str, end: str) -> DataFrame:
    """``[start, end)``: the day bound prunes folders, the time bound cuts the edges."""
    rows = spark.read.option("basePath", path).parquet(path)
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    days = (F.col("fecha_dia") >= F.to_date(first)) & (F.col("fecha_dia") <= F.to_date(last))
    return rows.where(days & (F.col(time) >= first) & (F.col(time) < last)).drop("fecha_dia")


def element_index(documents: DataFrame, key: str, array: str, field: str) -> DataFrame:
    """Side table (value of the element field, document key), for lookups by element."""
    return unwind(documents.select(key, array), array, "_e").select(F.col(f"_e.{field}").alias(field), key).distinct()


def with_hot_keys(df: DataFrame, json_column: str, keys: dict[str, str]) -> DataFrame:
    """Often-filtered JSON keys as real columns, written beside the ``VARIANT``."""
    return df.withColumns({name: F.try_variant_get(json_column, f"$.{name}", kind) for name, kind in keys.items()})

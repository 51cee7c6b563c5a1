"""Calendar parts and the integer date key used by the warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """``2026-03-15`` -> ``20260315``."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_columns(day: str) -> list[Column]:
    return [
        date_key(day).alias("fecha_key"),
        F.col(day).alias("fecha"),
        F.year(day).cast("smallint").alias("anio"),
        F.month(day).cast("smallint").alias("mes"),
        F.dayofmonth(day).cast("smallint").alias("dia"),
        F.quarter(day).cast("smallint").alias("trimestre"),
    ]

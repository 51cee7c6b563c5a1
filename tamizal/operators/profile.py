"""One-pass column profile and row counts per source file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamizal.operators.relational import exact_mean


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: counts, nulls, extremes, approximate distinct values and quartiles.

    Everything is a partial aggregate of a single scan; the result has as many rows as columns.
    """
    measures = []
    for f in df.schema:
        column = F.col(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        orderable = not isinstance(f.dataType, (T.MapType, T.VariantType, T.ArrayType, T.StructType))
        number = column.cast("double") if numeric else F.lit(None).cast("double")
        text = column.cast("string") if orderable and not numeric else F.lit(None).cast("string")
        mean = exact_mean(column) if numeric else F.lit(None).cast("double")
        distinct = F.approx_count_distinct(column) if orderable else F.lit(None).cast("bigint")
        quartiles = (
            F.percentile_approx(number, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
            if numeric
            else F.lit(None).cast("array<double>")
        )
        measures.append(
            F.struct(
                F.lit(f.name).alias("columna"),
                F.lit(f.dataType.simpleString()).alias("tipo"),
                F.count(F.lit(1)).alias("filas"),
                (F.count(F.lit(1)) - F.count(column)).alias("nulos"),
                F.min(number).alias("minimo"),
                F.max(number).alias("maximo"),
                F.min(text).alias("primero"),
                F.max(text).alias("ultimo"),
                mean.alias("media"),
                (F.stddev_samp(number) if numeric else F.lit(None).cast("double")).alias("desviacion"),
                distinct.alias("distintos_aprox"),
                quartiles.alias("cuartiles_aprox"),
            )
        )
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def rows_per_source(frames: dict[str, DataFrame], source: str = "archivo_origen", batch: str = "lote_id") -> DataFrame:
    """Rows of every entity per batch and file."""
    parts = [
        df.groupBy(batch, source).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(n).alias("entidad"), batch, source, "filas")
        for n, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)

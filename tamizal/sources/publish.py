"""Versioned publication: tables are written aside, checked, and become current all at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.session import remove_folder, side_by_side
from tamizal.sources.layout import write_partitioned

LEDGER = "version string, carpeta string, publicado_en timestamp"


Folders = tuple[list[str], list[str]]  # columns that name the folders, columns sorted inside


def write_table(df: DataFrame, path: str, folders: Folders | None = None, mode: str = "overwrite") -> DataFrame:
    """Parquet with ZSTD; returns the table as read back, so later steps start from files."""
    if folders is None:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    else:
        write_partitioned(df, path, *folders)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Optional sink: a database table, for a warehouse outside the lake."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def _current(spark: SparkSession, root: str) -> tuple[str, str] | None:
    try:
        ledger = spark.read.schema(LEDGER).parquet(f"{root}/_published")
    except AnalysisException:
        return None
    return ledger.select(F.max_by(F.struct("version", "carpeta"), "publicado_en")).first()[0]


def current_version(spark: SparkSession, root: str) -> str | None:
    found = _current(spark, root)
    return None if found is None else found[0]


def current_folder(spark: SparkSession, root: str) -> str:
    found = _current(spark, root)
    if found is None:
        raise LookupError(f"nothing is published under {root}")
    return f"{root}/{found[1]}"


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{current_folder(spark, root)}/{table}")


def write_version(
    root: str, version: str, tables: dict[str, DataFrame], folders: dict[str, Folders] | None = None
) -> tuple[str, dict[str, DataFrame]]:
    """Write the tables of a run to a folder of its own; gives the folder and the tables as read back.

    A version may be run again: nothing that an earlier run wrote is touched.
    """
    spark, chosen = next(iter(tables.values())).sparkSession, folders or {}
    folder = f"version={version}/run={uuid.uuid4().hex}"
    calls = [partial(write_table, df, f"{root}/{folder}/{name}", chosen.get(name)) for name, df in tables.items()]
    return folder, dict(zip(tables, side_by_side(spark, calls)))


def name_current(spark: SparkSession, root: str, version: str, folder: str) -> None:
    """Make a written folder the one that readers see, by one appended row."""
    entry = spark.range(1).select(
        F.lit(version).alias("version"), F.lit(folder).alias("carpeta"), F.current_timestamp().alias("publicado_en")
    )
    entry.write.mode("append").parquet(f"{root}/_published")


def publish(
    spark: SparkSession,
    root: str,
    version: str,
    tables: dict[str, DataFrame],
    check: Callable[[dict[str, DataFrame]], None],
    folders: dict[str, Folders] | None = None,
) -> dict[str, DataFrame]:
    """Write every table of a version, run ``check`` on what was written, then name it current.

    ``check`` raises to refuse; what was current before stays so and readable, also if it is an earlier
    run of the same version.
    """
    folder, written = write_version(root, version, tables, folders)
    check(written)
    name_current(spark, root, version, folder)
    return written


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of published runs that are not among the last ``keep``; gives the removed ones.

    The ledger says which: its rows stay, and a folder that it does not name, such as a refused run's or one that
    is being written, is left alone. Readers of the last runs are not touched.
    """
    ledger = spark.read.schema(LEDGER).parquet(f"{root}/_published")
    last = {r["carpeta"] for r in ledger.groupBy("carpeta").agg(F.max("publicado_en").alias("t")).orderBy(F.desc("t")).limit(max(keep, 1)).collect()}
    old = sorted(r["carpeta"] for r in ledger.select("carpeta").distinct().collect() if r["carpeta"] not in last)
    for folder in old:
        remove_folder(spark, f"{root}/{folder}")
    return old

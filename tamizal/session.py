"""Session settings, and the shared folder where intermediate tables are written."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Every one of these may be changed at run time, on a session someone else built.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key of a join even where the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Turn on run-time re-planning in ``spark``; sizes and memory stay the cluster's choice."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tamizal", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or a new one on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tamizal-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


_RUN = "tamizal.run"  # a local property, so that threads of a run have it too


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, in that of the run around it if there is one."""
    run = spark.sparkContext.getLocalProperty(_RUN)
    return os.path.join(shared_root(spark), "scratch", *([run] if run else []), f"{name}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of what runs inside are in one folder, which is removed at the end, also after a failure.

    Frames made inside must be written elsewhere before the end. A run inside another belongs to it.
    """
    context = spark.sparkContext
    outer = context.getLocalProperty(_RUN)
    if outer:
        yield os.path.join(shared_root(spark), "scratch", outer)
        return
    run = f"run-{uuid.uuid4().hex}"
    folder = os.path.join(shared_root(spark), "scratch", run)
    context.setLocalProperty(_RUN, run)
    try:
        yield folder
    finally:
        context.setLocalProperty(_RUN, None)
        remove_folder(spark, folder)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends at files, so a lost executor costs a re-read and never a re-computation,
    and Spark now knows the real size: joins against the result are broadcast only under
    ``spark.sql.autoBroadcastJoinThreshold`` and are sort-merge joins beyond it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, calls: list[Callable[[], T]]) -> list[T]:
    """Run independent steps at once, each from a thread of its own; their jobs share the cluster."""
    if len(calls) < 2:
        return [call() for call in calls]
    with ThreadPoolExecutor(max_workers=len(calls)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def materialize_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``materialize`` independent tables side by side."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    calls = [partial(materialize, df, name) for name, df in frames.items()]
    return dict(zip(frames, side_by_side(spark, calls)))

"""What tables, columns and plans there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def tables_like(spark: SparkSession, prefix: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))


def column_inventory(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table, position, column, type and nullability, from the schemas alone."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema, start=1)
    ]
    schema = "tabla string, posicion int, columna string, tipo string, admite_nulos boolean"
    return spark.createDataFrame(rows, schema).orderBy("tabla", "posicion")


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan."""
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scanned_and_returned(source: DataFrame, filtered) -> dict[str, int]:
    """Rows read from ``source`` against rows left by ``filtered(source)``."""
    read, kept = Observation(), Observation()
    counted = filtered(source.observe(read, F.count(F.lit(1)).alias("n"))).observe(kept, F.count(F.lit(1)).alias("n"))
    counted.write.format("noop").mode("overwrite").save()
    return {"scanned": read.get["n"], "returned": kept.get["n"]}


_STAGES = ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec", "TableCacheQueryStageExec")


def _nodes(plan):
    """Nodes of an executed plan, through what adaptive execution put around them."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
        return
    yield plan
    if name in _STAGES:
        yield from _nodes(plan.plan())
        return
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def work_done(df: DataFrame) -> dict[str, int]:
    """Run ``df`` and tell files and rows its scans gave, row groups' filters included, and the exchanges it had."""
    df.collect()
    done = {"files": 0, "rows": 0, "exchanges": 0}
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            done["files"] += metrics.apply("numFiles").value()
            done["rows"] += metrics.apply("numOutputRows").value()
        done["exchanges"] += name == "ShuffleExchangeExec"
    return done

"""One key holds a third of all rows: results stay exact and no step gathers that key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tamizal.operators import quality, ranking, relational
from tamizal.plans import dirty
from tamizal.plans.entities import DATASETS, ENTITIES, METRICAS, TIPOS_FUENTE
from tamizal.plans.medallion import evaluate_in_order
from tamizal.session import tune


def skewed(spark, n=9000):
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("clave"),
        F.when(F.col("id") % 101 == 0, F.lit(None)).when(hot & (F.col("id") % 2 == 0), F.lit(7)).otherwise(F.col("id") % 977).alias("valor"),
        F.col("id"),
    )


def test_ranks_equal_plain_windows(spark):
    df = skewed(spark).cache()
    for keys in (["clave"], []):
        for limit in (40, 1, None):
            ours = ranking.add_row_number(df, keys, [("valor", "desc")], ["id"], "n", limit)
            ours = ranking.add_rank(ours, keys, [("valor", "desc")], "r", "d", limit)
            by_row = Window.partitionBy(*keys).orderBy(F.col("valor").desc(), "id")
            by_value = Window.partitionBy(*keys).orderBy(F.col("valor").desc())
            want = df.withColumns({"n": F.row_number().over(by_row), "r": F.rank().over(by_value), "d": F.dense_rank().over(by_value)})
            cols = ["id", "n", "r", "d"]
            assert sorted(map(tuple, ours.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_buckets_are_balanced_under_a_hot_key(spark):
    dealt = ranking.ranged(skewed(spark), [("clave", "asc"), ("valor", "desc"), ("id", "asc")], 20)
    sizes = [r["count"] for r in dealt.groupBy("_bucket").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3 * 450


def test_many_ranges_put_nothing_into_a_row(spark):
    """Bounds are Spark's own: the row gains two numbers whether there are two ranges or a thousand."""
    df = skewed(spark, 3000)
    for ranges in (2, 1000):
        dealt = ranking.ranged(df, [("valor", "asc"), ("id", "asc")], ranges)
        assert set(dealt.columns) - set(df.columns) == {"_bucket", "_place"}
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and dealt.count() == 3000
    ours = ranking.add_row_number(df, [], [("valor", "asc")], ["id"], "n", 1000)
    assert ours.agg(F.sum("n"), F.countDistinct("n")).first()[:] == (3000 * 3001 // 2, 3000)


def test_ranks_of_every_type(spark):
    """Text, booleans, timestamps without zone, NaN, infinity, nulls and the smallest integer, both ways."""
    rows = spark.range(600).select(
        "id",
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("t"), F.col("id") % 50)).alias("texto"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 2 == 0).alias("si"),
        F.expr("CASE WHEN id % 11 <> 0 THEN timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 30 AS INT)) END").alias("cuando"),
        F.expr("CASE WHEN id % 13 = 0 THEN double('NaN') WHEN id % 17 = 0 THEN double('-Infinity') WHEN id % 19 <> 0 THEN id % 40 / 8.0D END").alias("real"),
        F.expr("CASE WHEN id % 23 = 0 THEN -9223372036854775807L - 1 WHEN id % 29 <> 0 THEN id % 25 END").alias("entero"),
    ).cache()
    for column in ("texto", "si", "cuando", "real", "entero"):
        for direction in ("asc", "desc"):
            order = F.col(column).asc() if direction == "asc" else F.col(column).desc()
            want = rows.select("id", F.row_number().over(Window.orderBy(order, "id")).alias("n"), F.rank().over(Window.orderBy(order)).alias("r"))
            ours = ranking.add_row_number(rows.select("id", column), [], [(column, direction)], ["id"], "n", 12)
            ours = ranking.add_rank(ours, [], [(column, direction)], "r", None, 7)
            assert sorted(map(tuple, ours.select("id", "n", "r").collect())) == sorted(map(tuple, want.collect())), (column, direction)


def test_means_are_not_cut(spark):
    cases = [([1e-8, 3e-8], 2e-8), ([1e23, 3e23], 2e23), ([0.1, 0.2, 0.3], 0.2), ([float("inf"), 1.0], float("inf")), ([None, 4.0], 4.0), ([None], None), ([1e300, 1.0], 5e299), ([1e-300, 3e-300], 2e-300), ([1e20, 1e-10], 5e19)]
    for values, mean in cases:
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        assert frame.select(relational.exact_mean("v")).first()[0] == (mean if mean is None else pytest.approx(mean, rel=1e-15))
    exact = spark.sql("SELECT CAST(0.1234567891 AS DECIMAL(38,10)) AS v").select(relational.exact_mean("v")).first()[0]
    assert exact == 0.1234567891
    shown = spark.sql("SELECT 1e19D AS a, 2.00005D AS b, 0.12344999999D AS c").select(*[relational.rounded(F.col(c)) for c in "abc"]).first()
    assert tuple(shown) == (1e19, 2.0001, 0.1234)


def test_means_are_rounded_once_from_the_exact_quotient(spark):
    from decimal import Decimal

    cases = [
        (["3959.58"], 80, 49.4948), (["0.00005"], 1, 0.0001), (["-0.00005"], 1, -0.0001), (["0.000049999999"], 1, 0.0), (["-3959.58"], 80, -49.4948),
        (["1", "0", "0"], 3, 0.3333), (["2", "0", "0"], 3, 0.6667), (["123456789012345.00005"], 1, 123456789012345.0001), (["1e-8", "3e-8"], 2, 0.0), (["1e23", "3e23"], 2, 2e23),
    ]
    for values, count, mean in cases:
        rows = [(float(v),) for v in values] + [(0.0,)] * (count - len(values))
        assert spark.createDataFrame(rows, "v double").select(relational.rounded_mean("v")).first()[0] == mean, values
    # one path: a longer fraction beside others changes nothing for them
    mixed = spark.createDataFrame([(49.49475,)] * 80 + [(1e-9,)] * 0, "v double").repartition(7)
    assert mixed.select(relational.rounded_mean("v")).first()[0] == 49.4948
    frame = spark.createDataFrame([(Decimal("0.5"), 4, 1), (Decimal("-1"), 8, 1), (None, 3, 0)], "t decimal(28,6), n bigint, k int")
    assert [r[0] for r in frame.select(relational.quotient(F.col("t"), F.col("n"), 3)).collect()] == [0.125, -0.125, None]
    assert [r[0] for r in frame.select(relational.quotient(F.col("t"), F.col("n"), 2)).collect()] == [0.13, -0.13, None]
    assert spark.createDataFrame([(None,)], "v double").select(relational.rounded_mean("v")).first()[0] is None
    assert spark.createDataFrame([(float("nan"),), (1.0,)], "v double").select(relational.rounded_mean("v")).first()[0] != 0


def test_group_value_equals_window(spark):
    df = skewed(spark).cache()
    ours = ranking.with_group_value(df, ["clave"], m=F.avg("valor"))
    want = df.withColumn("m", F.avg("valor").over(Window.partitionBy("clave")))
    assert sorted(map(str, ours.select("id", "m").collect())) == sorted(map(str, want.select("id", "m").collect()))


def _lineage(df):
    return df.withColumns({
        "lote_id": F.lit("a"), "archivo_origen": F.lit("f"), "numero_fila": F.col("n"), "ingerido_en": F.current_timestamp(),
    })


def test_hot_repeated_key(spark):
    """A third of the rows repeat one key: exactly one keeps it, and NULL keys are not repeats."""
    raw = _lineage(spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "0").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("id"),
        F.lit("x").alias("nombre"), (6000 - F.col("id")).alias("n"),
    ))
    out = quality.evaluate(raw, TIPOS_FUENTE).cache()
    found = {r["codigo_error"]: r["n"] for r in out.groupBy("codigo_error").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {None: 2001, "DUPLICATE_KEY": 1999, "MISSING_REQUIRED": 2000}
    kept = out.where("id = 0 AND codigo_error IS NULL").collect()
    assert len(kept) == 1 and kept[0]["numero_fila"] == 3


def test_repeats_are_decided_before_validity(spark):
    rows = [("1", "9", " accuracy", "2", "2026-01-01T00:00:00Z", 1), ("1", "9", "accuracy", "0.5", "2026-01-01T00:00:00Z", 2)]
    raw = _lineage(spark.createDataFrame(rows, "id string, experimento_id string, nombre string, valor string, fecha_registro string, n int"))
    parents = {"experimentos": spark.createDataFrame([(9,)], "id long")}
    codes = [r["codigo_error"] for r in quality.evaluate(raw, METRICAS, parents).orderBy("numero_fila").collect()]
    assert codes == ["INVALID_RANGE", "DUPLICATE_KEY"]


def test_checks_do_not_shuffle_the_rows(spark):
    """The rows meet the offending keys in broadcast joins: no exchange of rows in the plan."""
    raw = _lineage(spark.range(100).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 5).cast("string").alias("usuario_id"), F.lit("n").alias("nombre"),
        (F.col("id") % 3).cast("string").alias("tipo_fuente_id"), F.lit("d").alias("fuente_detalle"), F.lit("5").alias("cantidad_registros"), F.lit("2026-01-01T00:00:00Z").alias("fecha_creacion"), F.col("id").alias("n"),
    ))
    parents = {"usuarios": spark.range(9), "tipos_fuente": spark.range(9)}
    out = quality.evaluate(raw, DATASETS, parents)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3
    assert out.where("codigo_error IS NULL").count() == 100


def test_same_result_beyond_the_broadcast_limit(spark):
    """With broadcasts off the same joins become sort-merge joins and give the same rows."""
    raw = _lineage(spark.range(3000).select(
        (F.col("id") % 2900).cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 50).cast("string")).alias("usuario_id"),
        F.lit("n").alias("nombre"), F.lit("1").alias("tipo_fuente_id"), F.lit("d").alias("fuente_detalle"), F.lit("5").alias("cantidad_registros"),
        F.lit("2026-01-01T00:00:00Z").alias("fecha_creacion"), F.col("id").alias("n"),
    ))
    parents = {"usuarios": spark.range(25), "tipos_fuente": spark.range(3)}
    want = sorted(map(str, quality.evaluate(raw, DATASETS, parents).drop("ingerido_en").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quality.evaluate(raw, DATASETS, parents).drop("ingerido_en")
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, out.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_dealt_to_tasks_by_their_number(spark, tmp_path, monkeypatch):
    """A table of one row group is one task's scan; what is made of it is not."""
    events = spark.range(1000).select(
        F.col("id").alias("event_id"), F.lit("view").alias("event_type"), F.lit(0.5).alias("value"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts")
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(dirty, "ROWS_PER_TASK", 100, raising=False)
    rows = dirty.raw(spark, str(tmp_path), "metricas")
    assert rows.rdd.getNumPartitions() >= 10 and rows.count() == 1020


def test_rows_are_cleaned_once(spark):
    """What checks and uses read are typed columns from files: keys, references and those asked for."""
    raw = _lineage(spark.range(100).select(
        (F.col("id") % 90).cast("string").alias("id"), F.when(F.col("id") % 9 == 1, " ").otherwise(" a  b ").alias("nombre"), F.lit("e").alias("email"),
        F.when(F.col("id") % 9 == 2, "x").otherwise("SI").alias("activo"), F.when(F.col("id") % 9 < 5, "31/02/2024").otherwise("2024-01-01").alias("fecha_alta"), F.col("id").alias("n"),
    ))
    out = evaluate_in_order(spark, lambda _: raw, ["usuarios"], columns={"usuarios": ["nombre"]})["usuarios"]
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "regexp_replace" not in plan and "rlike" not in plan
    whole = quality.evaluate(raw, ENTITIES["usuarios"])
    compared = [c for c in out.columns if c != "ingerido_en"]
    assert sorted(map(str, out.select(compared).collect())) == sorted(map(str, whole.select(compared).collect()))
    assert "activo" not in out.columns and {"id", "nombre", "evidencia_original", "codigo_error"} <= set(out.columns)
    found = {r["codigo_error"]: r["count"] for r in out.groupBy("codigo_error").count().collect()}
    assert found == {None: 40, "MISSING_REQUIRED": 11, "DUPLICATE_KEY": 9, "INVALID_BOOLEAN": 10, "INVALID_DATE": 30}


def test_tune_is_idempotent(spark):
    assert tune(tune(spark)).conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"

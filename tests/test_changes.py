"""Constraints, inserts, updates, catalogs, snapshots, layouts, introspection."""

import datetime as dt

import fixture
import pytest
from pyspark.sql import functions as F

from tamizal.operators import constraints as c
from tamizal.operators import introspect, mutate
from tamizal.operators.views import Snapshot
from tamizal.sources import layout
from tamizal.sources.registry import generate_metrics
from tamizal.sources.schemas import REGISTRY, REGISTRY_CONSTRAINTS, create_namespaces, defaults


def row(spark, table, **values):
    schema = REGISTRY[table]
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema)


def broken(registry, spark, table, **values):
    grown = {**registry, table: registry[table].unionByName(row(spark, table, **values))}
    return {(r["tipo"], r["restriccion"]) for r in c.violations(grown, [k for k in REGISTRY_CONSTRAINTS if k.table == table]).collect()}


def test_registry_is_valid(registry):
    c.require_valid(registry, REGISTRY_CONSTRAINTS)


@pytest.mark.parametrize(
    "table, values, kind",
    [
        ("usuarios", {"id": 50, "nombre": "sin", "activo": True}, ("NOT NULL", "usuarios_email_not_null")),
        ("usuarios", {"id": 50, "nombre": "Otra", "email": "obs1@cielo.example", "activo": True}, ("UNIQUE", "usuarios_email_key")),
        ("datasets", {"id": 50, "usuario_id": 999, "nombre": "x"}, ("FOREIGN KEY", "datasets_usuario_id_fkey")),
        ("modelos", {"id": 50, "usuario_id": 999, "nombre": "x", "tipo_modelo_id": 1}, ("FOREIGN KEY", "modelos_usuario_id_fkey")),
        ("experimentos", {"id": 50, "dataset_id": 999, "nombre": "x"}, ("FOREIGN KEY", "experimentos_dataset_id_fkey")),
        ("metricas", {"id": 50, "experimento_id": 999, "nombre": "accuracy", "valor": 1}, ("FOREIGN KEY", "metricas_experimento_id_fkey")),
        ("metricas", {"id": 50, "experimento_id": 1, "nombre": "accuracy", "valor": -1}, ("CHECK", "metricas_valor_check")),
        ("experimentos_modelos", {"experimento_id": 1, "modelo_id": 2}, ("PRIMARY KEY", "experimentos_modelos_pkey")),
    ],
)
def test_each_bad_insert_is_found(spark, registry, table, values, kind):
    from decimal import Decimal

    values = {k: Decimal(v) if k == "valor" else v for k, v in values.items()}
    assert broken(registry, spark, table, **values) == {kind}


def test_valid_insert_with_defaults(spark, registry):
    now = F.lit(dt.datetime(2026, 4, 1)).cast("timestamp_ntz")
    new = mutate.literal_rows(spark, [(50, "Usuario válido", "ok@example.com", None, None)], REGISTRY["usuarios"], defaults(now)["usuarios"])
    assert new.first()["activo"] is True and new.first()["fecha_alta"] == dt.datetime(2026, 4, 1)
    grown = mutate.insert_rows(registry["usuarios"], new, ["id"])
    c.require_valid({**registry, "usuarios": grown}, REGISTRY_CONSTRAINTS)


def test_rules_read_every_table_once(spark, registry, tmp_path):
    from pyspark.sql import Observation

    seen = {name: Observation() for name in registry}
    watched = {name: df.observe(seen[name], F.count(F.lit(1)).alias("n")) for name, df in registry.items()}
    read = {name: [] for name in registry}
    original = c._said
    try:
        c._said = lambda rows, rules: read[rules[0].table].append(len(rules)) or original(rows, rules)
        assert c.violations(watched, REGISTRY_CONSTRAINTS).isEmpty()
    finally:
        c._said = original
    per_table = {}
    for rule in REGISTRY_CONSTRAINTS:
        per_table[rule.table] = per_table.get(rule.table, 0) + 1
    assert read == {name: [per_table[name]] for name in registry}
    assert {name: s.get["n"] for name, s in seen.items()} == {name: df.count() for name, df in registry.items()}


def test_restricted_delete(registry):
    children = {"datasets": (registry["datasets"], "usuario_id"), "modelos": (registry["modelos"], "usuario_id")}
    with pytest.raises(c.ConstraintError, match="still refers to 2"):
        c.delete_restricted(registry["usuarios"], F.col("id") == 2, "id", children)
    assert c.delete_restricted(registry["usuarios"], F.col("id") == 11, "id", {"datasets": children["datasets"]}).count() == fixture.USERS - 1


def test_constraint_inventory(spark):
    found = c.inventory(spark, REGISTRY_CONSTRAINTS)
    fk = found.where("tipo = 'FOREIGN KEY' AND tabla = 'datasets'").select("columna", "tabla_referida", "columna_referida")
    assert sorted(map(tuple, fk.collect())) == [("tipo_fuente_id", "tipos_fuente", "id"), ("usuario_id", "usuarios", "id")]
    assert found.where("restriccion = 'experimentos_modelos_pkey'").count() == 2


MAPPING = {detail: fixture.SOURCES[kind - 1] for detail, kind in fixture.DETAILS.items()}


def test_free_text_becomes_a_catalog_key(registry):
    free = registry["datasets"].withColumn("fuente", F.col("fuente_detalle")).drop("fuente_detalle", "tipo_fuente_id")
    normal = mutate.normalize_column(free, "fuente", MAPPING, registry["tipos_fuente"], "tipo_fuente_id", "fuente_detalle")
    assert mutate.unclassified(normal, "tipo_fuente_id").isEmpty() and "fuente" not in normal.columns
    same = ["id", "tipo_fuente_id", "fuente_detalle"]
    assert sorted(map(tuple, normal.select(same).collect())) == sorted(map(tuple, registry["datasets"].select(same).collect()))
    edited = mutate.update_where(free, F.col("id") == 1, {"fuente": F.lit("Globo")})
    left = mutate.unclassified(mutate.normalize_column(edited, "fuente", MAPPING, registry["tipos_fuente"], "t", "detalle"), "t")
    assert [tuple(r) for r in left.select("id", "detalle").collect()] == [(1, "Globo")]


def test_repeated_value_becomes_a_catalog(spark, registry):
    names = registry["tipos_modelo"].select(F.col("id").alias("tipo_modelo_id"), F.col("nombre").alias("tipo"))
    models = registry["modelos"].join(names, "tipo_modelo_id").drop("tipo_modelo_id")
    catalog = mutate.catalog_from(models, "tipo")
    assert sorted(map(tuple, catalog.collect())) == list(enumerate(sorted(fixture.MODEL_KINDS), start=1))
    assert mutate.resolve_key(models, catalog, "tipo", "nombre", "id", "tipo_modelo_id").where("tipo_modelo_id IS NULL").isEmpty()


def test_natural_keys(spark, registry):
    new = spark.createDataFrame([("obs1@cielo.example", "d1"), ("nadie@example.com", "d2")], "email string, nombre string")
    found = mutate.resolve_key(new, registry["usuarios"], "email", "email", "id", "usuario_id")
    assert sorted(map(tuple, found.select("nombre", "usuario_id").collect())) == [("d1", 1), ("d2", None)]
    twice = registry["usuarios"].unionByName(registry["usuarios"].where("id = 1"))
    with pytest.raises(Exception, match="more than one row for obs1@cielo.example"):
        mutate.resolve_key(new, twice, "email", "email", "id", "usuario_id").collect()


def test_update_delete_seed_and_counters(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, None, 7)], "id int, t string, n int")
    changed = mutate.update_where(df, F.col("n") > 5, {"t": F.lit("z"), "n": F.col("n") + 1})
    assert sorted(map(tuple, changed.collect())) == [(1, "a", None), (2, "b", 5), (3, "z", 8)]
    assert mutate.delete_where(df, F.col("t") == "b").count() == 2
    assert mutate.seed_if_absent(df, df.withColumn("id", F.col("id") + 1), ["id"]).count() == 4
    watched, seen = mutate.counted(df, F.col("n") > 4)
    watched.write.parquet(str(tmp_path / "w"))
    assert seen.get == {"matched": 2, "scanned": 3}
    assert mutate.add_column(mutate.add_column(df, "j", "variant"), "j", "string").columns == ["id", "t", "n", "j"]
    assert mutate.drop_column(df, "j").columns == ["id", "t", "n"]
    values = spark.createDataFrame([(2, '{"a":1}')], "id int, j string")
    assert {r["id"]: r["j"] for r in mutate.set_by_key(df, values, ["id"], "j").collect()} == {1: None, 2: '{"a":1}', 3: None}
    ids = mutate.assign_ids(spark.createDataFrame([("y", None), ("x", None)], "t string, id int"), df.select("id", "t"), ["t"])
    assert sorted(map(tuple, ids.select("id", "t").collect())) == [(4, "x"), (5, "y")]


def test_matched_and_modified(spark):
    df = spark.sql("""SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE 'a' END AS t, map('x', id % 2) AS m, parse_json(concat('{"k":', id % 2, '}')) AS v FROM range(12)""")
    cases = [
        ({"t": F.lit("a")}, {"matched": 12, "modified": 4, "scanned": 12}, None),
        ({"t": F.lit(None)}, {"matched": 12, "modified": 8, "scanned": 12}, None),
        ({"t": F.lit("b")}, {"matched": 3, "modified": 3, "scanned": 12}, F.col("id") > 8),
        ({"m": F.create_map(F.lit("x"), F.lit(1).cast("bigint"))}, {"matched": 12, "modified": 6, "scanned": 12}, None),
        ({"v": F.parse_json(F.lit('{"k": 0}')), "t": F.col("t")}, {"matched": 12, "modified": 6, "scanned": 12}, None),
        ({"t": F.lit("z")}, {"matched": 0, "modified": 0, "scanned": 12}, F.lit(None).cast("boolean")),
    ]
    for values, want, test in cases:
        changed, seen = mutate.counted_update(df, test, values)
        assert changed.columns == df.columns
        rows = changed.select("id", "t", F.to_json("m"), F.to_json("v")).collect()
        plain = mutate.update_where(df, test, values).select("id", "t", F.to_json("m"), F.to_json("v")).collect()
        assert sorted(map(str, rows)) == sorted(map(str, plain))
        assert seen.get == want


def test_containment_compares_numbers_by_kind(spark):
    from decimal import Decimal

    from tamizal.functions.jsonb import contains

    cases = [
        ("9007199254740993", 9007199254740992, False), ("9007199254740993", 9007199254740993, True), ("9007199254740993.0", 9007199254740993, True),
        ("1", 1.0, True), ("1.50", "1.5", True), ("1.5", 2, False), ("1e0", 1, True), ("-0.1", "-0.1", True), ("0.1", 0.1, True), ("7", '"7"', False),
        ("123456789012345678901234567890", "123456789012345678901234567890", True), ("123456789012345678901234567891", "123456789012345678901234567890", False),
        ("1.00000000000000000000001", 1, False), ("18446744073709551616", 0, False), ("1e300", "1e300", True), ("0.30000000000000004", "0.3", False),
    ]
    for text, wanted, same in cases:
        fragment = f'{{"k": {wanted}}}' if isinstance(wanted, str) else {"k": wanted}
        row = spark.sql(f"""SELECT parse_json('{{"k": {text}}}') AS v""")
        assert row.select(contains("v", fragment)).first()[0] is same, (text, wanted)
        assert spark.sql(f"SELECT parse_json('[3.5, {text}]') AS v").select(contains("v", [Decimal(str(wanted).strip('"'))] if not isinstance(wanted, str) or '"' not in wanted else [wanted.strip('"')])).first()[0] is same


def test_snapshot(spark, tmp_path):
    state = {"n": 2}
    stored = Snapshot(spark, str(tmp_path / "s"), lambda: spark.range(state["n"]))
    with pytest.raises(LookupError):
        stored.read()
    stored.refresh()
    state["n"] = 5
    assert stored.read().count() == 2
    stored.refresh()
    assert stored.read().count() == 5


def test_parted_snapshot_equals_the_whole(spark, tmp_path):
    from tamizal.operators.views import PartedSnapshot

    rows = spark.range(500).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 11 > 0, F.col("id") / 8).alias("v"), (F.col("id") % 4).alias("b"))
    stored = PartedSnapshot(spark, str(tmp_path / "s"), ["k"], "v")
    for batch in range(4):
        stored.refresh(str(batch), rows.where(F.col("b") == batch))
        got = {r["k"]: tuple(r)[1:] for r in stored.read().collect()}
        done = rows.where(F.col("b") <= batch).groupBy("k").agg(F.count(F.lit(1)), F.round(F.avg("v"), 4), F.min("v"), F.max("v"))
        assert got == {r["k"]: tuple(r)[1:] for r in done.collect()}
    before = stored.read().collect()
    stored.refresh("2", rows.where(F.col("b") == 2))
    assert sorted(map(str, stored.read().collect())) == sorted(map(str, before))


def test_layouts_skip_what_is_not_asked_for(spark, tmp_path):
    """Files and row groups that a query does not read, by scan metrics."""
    df = spark.range(40_000).select("id", (F.col("id") % 8).alias("k"), F.format_string("u%06d", F.pmod(F.xxhash64("id"), F.lit(10**6))).alias("u"))
    layout.write_partitioned(df, str(tmp_path / "p"), ["k"], ["id"])
    assert introspect.work_done(spark.read.parquet(str(tmp_path / "p")).where("k = 3"))["rows"] == 5000
    small = {"parquet.block.size": "20000", "parquet.page.size": "2000", "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "50"}
    for key, value in small.items():
        spark._jsc.hadoopConfiguration().set(key, value)
    try:
        layout.write_sorted(df, str(tmp_path / "o"), ["id"])
        layout.write_bloom(df.coalesce(1), str(tmp_path / "f"), "u", 20_000)
    finally:
        for key in small:
            spark._jsc.hadoopConfiguration().unset(key)
    near = introspect.work_done(spark.read.parquet(str(tmp_path / "o")).where("id BETWEEN 20000 AND 20009"))
    assert 10 <= near["rows"] < 10_000
    one = df.where("id = 77").first()["u"]
    point = introspect.work_done(spark.read.parquet(str(tmp_path / "f")).where(F.col("u") == one))
    nobody = introspect.work_done(spark.read.parquet(str(tmp_path / "f")).where("u = 'u5x0000'"))
    assert nobody["rows"] == 0 and 0 < point["rows"] < 40_000


def test_layouts(spark, tmp_path, registry):
    path = str(tmp_path / "p")
    layout.write_partitioned(registry["metricas"], path, ["nombre"], ["id"])
    found = spark.read.parquet(path).where("nombre = 'accuracy'")
    assert found.count() == len(fixture.value_of("accuracy")) and "PartitionFilters: [isnotnull(nombre" in introspect.plan_text(found)
    layout.write_bucketed(registry["datasets"], "datasets_b", ["usuario_id"], 4)
    layout.write_bucketed(registry["modelos"], "modelos_b", ["usuario_id"], 4)
    joined = spark.table("datasets_b").join(spark.table("modelos_b").hint("merge"), "usuario_id")
    assert "Exchange hashpartitioning" not in introspect.plan_text(joined) and joined.count() > 0
    layout.write_sorted(registry["metricas"], str(tmp_path / "o"), ["experimento_id", "fecha_registro"])
    layout.write_bloom(registry["usuarios"], str(tmp_path / "f"), "email", 10)
    assert spark.read.parquet(str(tmp_path / "f")).where("email = 'obs1@cielo.example'").count() == 1
    rows = [("2026-06-15T10:30:00", "exp-006", "accuracy", 0.94), ("2026-06-15T10:31:00", "exp-006", "loss", 0.18), ("2026-06-16T10:30:00", "exp-006", "accuracy", 0.95)]
    series = spark.createDataFrame(rows, "f string, e string, n string, valor double").select(F.col("f").cast("timestamp_ntz").alias("fecha"), "e", "n", "valor")
    layout.write_time_series(series, str(tmp_path / "t"), "fecha", ["e"])
    day = layout.read_time_range(spark, str(tmp_path / "t"), "fecha", "2026-06-15", "2026-06-16").where("e = 'exp-006'")
    assert day.count() == 2 and "fecha_dia" in introspect.plan_text(day)
    hot = layout.with_hot_keys(registry["experimentos_modelos"], "parametros_jsonb", {"rule": "string", "depth": "int"})
    assert hot.where("rule = 'gini' AND depth = 3").count() == sum('"depth":3,"rule":"gini"' in r["parametros_jsonb"] for r in fixture.table("experimentos_modelos"))


def test_element_index(registry):
    from tamizal.plans.document_store import build_experiments

    index = layout.element_index(build_experiments(registry), "_id", "ejecuciones", "modelo_id")
    assert sorted(r["_id"] for r in index.where("modelo_id = 'mod-006'").collect()) == sorted(fixture.code("exp", e) for e, m in fixture.runs() if m == 6)


def test_introspection(spark, registry):
    for name in ("usuarios", "metricas"):
        registry[name].createOrReplaceTempView(f"origen_{name}")
    assert introspect.tables_like(spark, "origen_") == ["origen_metricas", "origen_usuarios"]
    columns = introspect.column_inventory(spark, registry)
    assert columns.count() == sum(len(s) for s in REGISTRY.values())
    assert tuple(columns.where("tabla = 'metricas'").first())[:4] == ("metricas", 1, "id", "int")
    seen = introspect.scanned_and_returned(registry["metricas"], lambda d: d.where("nombre = 'accuracy'"))
    assert seen == {"scanned": len(fixture.table("metricas")), "returned": len(fixture.value_of("accuracy"))}
    create_namespaces(spark, "gold_ns", "control_ns")
    assert spark.catalog.databaseExists("gold_ns")


def test_generated_metrics(spark):
    made = generate_metrics(spark, 300).cache()
    assert {r["nombre"]: r["count"] for r in made.groupBy("nombre").count().collect()} == {"accuracy": 100, "precision": 100, "recall": 100}
    assert made.where("valor < 0.5 OR valor > 1").isEmpty()

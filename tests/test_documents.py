import json

import fixture as fx
import pytest
from pyspark.sql import functions as F

from tamizal.functions import arrays
from tamizal.operators import documents as shapes
from tamizal.operators import mutate
from tamizal.operators.nesting import elements_meet, first_element, lookup, nest, unwind, value_map
from tamizal.plans import document_store as q
from tamizal.sources.registry import load_documents


@pytest.fixture(scope="module")
def docs(registry):
    return q.build_experiments(registry).cache()


@pytest.fixture(scope="module")
def models(registry):
    return q.build_models(registry).cache()


def ids(df, column="_id"):
    return [r[column] for r in df.collect()]


def code(key):
    return fx.code("exp", key)


def test_build(docs):
    assert docs.count() == fx.EXPERIMENTS and docs.select("_id").distinct().count() == fx.EXPERIMENTS
    one = q.find_one(docs, "exp-006").select(F.size("ejecuciones").alias("n"), "dataset.propietario.nombre", F.map_keys("metricas").alias("k")).first()
    assert one["n"] == sum(e == 6 for e, _ in fx.runs()) and one["nombre"] == fx.names("usuarios")[fx.owner_of_experiment()[6]]
    assert sorted(one["k"]) == sorted(m["nombre"] for m in fx.table("metricas") if m["experimento_id"] == 6)


def test_filters(docs):
    experiments, accuracy = fx.table("experimentos"), fx.value_of("accuracy")
    assert ids(q.pending(docs)) == [code(e["id"]) for e in sorted(experiments, key=lambda e: (e["fecha"], e["id"])) if e["finalizado"] == "false"]
    assert sorted(ids(q.with_metric(docs, "mae"))) == [code(e) for e in fx.value_of("mae")]
    high = q.with_metric(docs, "accuracy", 0.7).collect()
    assert sorted(r["_id"] for r in high) == sorted(code(e) for e, v in accuracy.items() if v >= 0.7)
    assert [r["accuracy"] for r in high] == sorted((v for v in accuracy.values() if v >= 0.7), reverse=True)
    kind = {d["id"]: d["tipo_fuente_id"] for d in fx.table("datasets")}
    assert sorted(ids(q.by_source_type(docs, fx.SOURCES[0]))) == [code(e["id"]) for e in experiments if kind[e["dataset_id"]] == 1]
    assert sorted(ids(q.runs_of_model(docs, "mod-006"))) == sorted(code(e) for e, m in fx.runs() if m == 6)
    assert q.reading_view(docs).count() == fx.EXPERIMENTS
    first = min((e for e in experiments if e["finalizado"] == "false"), key=lambda e: e["nombre"])["id"]
    assert q.pending_detail(docs).first()["modelos"] == [fx.names("modelos")[m] for e, m in fx.runs() if e == first]


def test_elem_match(docs):
    held = [(r["experimento_id"], r["modelo_id"], json.loads(r["parametros_jsonb"])) for r in fx.table("experimentos_modelos")]
    low = lambda x: (x["tipo_modelo"] == "Red") & (q.run_parameter(x, "cut", "double") < 0.3)
    assert sorted(ids(q.runs_with(docs, low))) == sorted({code(e) for e, _, p in held if p.get("cut", 1) < 0.3})
    gini = lambda x: (x["tipo_modelo"] == "Árbol") & (q.run_parameter(x, "rule") == "gini")
    found = q.runs_with(docs, gini).select("_id", F.col("ejecuciones.modelo_id").alias("m")).collect()
    want = {}
    for e, m, p in held:
        if p.get("rule") == "gini":
            want.setdefault(code(e), (fx.code("mod", m),))
    assert {r["_id"]: tuple(r["m"]) for r in found} == want
    # each condition alone holds in some experiment of two runs, but never in the same run
    split = lambda x: (x["tipo_modelo"] == "Red") & (q.run_parameter(x, "rule") == "gini")
    both = [e for e in range(1, fx.EXPERIMENTS + 1) if any("rule" in p for f, _, p in held if f == e) and any("cut" in p for f, _, p in held if f == e)]
    assert both and ids(q.runs_with(docs, split)) == []


def test_unwind_and_references(docs, models):
    assert q.expand_runs(docs).count() == len(fx.runs())
    found = q.current_models(docs, models, "exp-006").select("modelo_id", "version_actual").collect()
    versions = {m["id"]: m["version"] for m in fx.table("modelos")}
    assert sorted(map(tuple, found)) == sorted((fx.code("mod", m), versions[m]) for e, m in fx.runs() if e == 6)
    assert q.dangling_runs(docs, models).count() == 0
    assert q.dangling_runs(docs, models.where("_id <> 'mod-006'")).count() == sum(m == 6 for _, m in fx.runs())


def test_aggregates(docs):
    accuracy, experiments = fx.value_of("accuracy"), {e["id"]: e for e in fx.table("experimentos")}
    kind = {d["id"]: fx.SOURCES[d["tipo_fuente_id"] - 1] for d in fx.table("datasets")}
    by_kind, by_owner = {}, {}
    for e, v in accuracy.items():
        by_kind.setdefault(kind[experiments[e]["dataset_id"]], []).append(v)
        by_owner.setdefault(fx.names("usuarios")[fx.owner_of_experiment()[e]], []).append(v)
    assert {r[0]: (r[1], round(r[2], 9)) for r in q.mean_by_source_type(docs).collect()} == {k: (len(v), round(fx.mean(v), 9)) for k, v in by_kind.items()}
    owners = {r["propietario"]: (r["cantidad"], round(r["accuracy_promedio"], 9)) for r in q.owners_with_minimum(docs).collect()}
    assert owners == {k: (len(v), round(fx.mean(v), 9)) for k, v in by_owner.items() if len(v) >= 2}
    trees = sorted((accuracy[e] for e, m in fx.runs() if e in accuracy and (m - 1) % 3 == 0), reverse=True)
    ranks = [(r["accuracy"], r["posicion"]) for r in q.rank_by_model_type(docs).collect() if r["tipo_modelo"] == "Árbol"]
    assert ranks == [(v, trees.index(v) + 1) for v in trees]
    first, second = fx.value_of("precision"), fx.value_of("recall")
    want = {code(e): round(first[e] - second[e], 6) for e in first if e in second}
    found = [(r["_id"], round(r["diferencia"], 6)) for r in q.metric_difference(docs).collect()]
    assert dict(found) == want and [v for _, v in found] == sorted(want.values(), reverse=True)


def test_change_cycle(docs):
    key = F.col("_id") == "tmp"
    copy = mutate.copy_row(docs, F.col("_id") == "exp-001", {"_id": F.lit("tmp"), "finalizado": F.lit(False)})
    copy = copy.withColumn("etiquetas", F.array(F.lit("temporal")))
    both = mutate.insert_rows(docs, copy, ["_id"])
    assert both.count() == fx.EXPERIMENTS + 1
    changed = mutate.set_field(both, "finalizado", F.lit(True), key)
    changed = mutate.set_field(changed, "dataset.nombre", F.lit("otro"), key)
    for _ in range(2):
        changed = mutate.add_to_set(changed, "etiquetas", F.lit("revisado"), key)
    changed = mutate.push(changed, "notas", F.struct(F.lit("estudiante").alias("autor"), F.lit("ok").alias("texto")), key)
    row = changed.where(key).select("finalizado", "dataset.nombre", "etiquetas", "notas").first()
    assert row["finalizado"] and row["nombre"] == "otro" and row["etiquetas"] == ["temporal", "revisado"] and len(row["notas"]) == 1
    assert changed.where(~key & F.col("notas").isNotNull()).isEmpty()
    pulled = mutate.pull(changed, "notas", lambda x: x["autor"] == "estudiante", key)
    assert pulled.where(key).first()["notas"] == []
    assert mutate.delete_where(pulled, key).count() == fx.EXPERIMENTS
    with pytest.raises(mutate.DuplicateKeyError):
        mutate.insert_rows(docs, docs.where("_id = 'exp-001'"), ["_id"])


def test_add_to_set_keeps_old_duplicates(spark):
    df = spark.sql("SELECT array('a', 'a') AS x, cast(NULL AS array<string>) AS y")
    out = df.select(arrays.add_to_set("x", F.lit("b")), arrays.add_to_set("x", F.lit("a")), arrays.add_to_set("y", F.lit("a")), arrays.push("y", F.lit("c"))).first()
    assert list(out) == [["a", "a", "b"], ["a", "a"], ["a"], ["c"]]


def test_validator(spark):
    good = {"_id": "e", "nombre": "n", "fecha": "2026-03-01", "finalizado": True, "dataset": {"dataset_id": 1, "nombre": "d", "propietario": {}}, "ejecuciones": [{}], "metricas": {}}
    cases = {
        "good": good,
        "short": {"_id": "x", "nombre": "Sin estructura"},
        "types": {**good, "finalizado": "true", "fecha": "ayer", "metricas": []},
        "sizes": {**good, "nombre": "", "ejecuciones": []},
        "inner": {**good, "dataset": {"dataset_id": 1}},
        "null": {**good, "finalizado": None},
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()] + [("broken", "{")], "k string, j string")
    found = {}
    for r in shapes.document_violations(df, "j", q.EXPERIMENT_SCHEMA, ["k"]).collect():
        found.setdefault(r["k"], set()).add(r["regla"])
    assert found == {
        "short": {f"$.{f}:required" for f in ("fecha", "finalizado", "dataset", "ejecuciones", "metricas")},
        "types": {"$.finalizado:bsonType", "$.fecha:bsonType", "$.metricas:bsonType"},
        "sizes": {"$.nombre:minLength", "$.ejecuciones:minItems"},
        "inner": {"$.dataset.nombre:required", "$.dataset.propietario:required"},
        "null": {"$.finalizado:bsonType"},
        "broken": {"$:json"},
    }
    assert [r["k"] for r in shapes.valid_documents(df, "j", q.EXPERIMENT_SCHEMA).collect()] == ["good"]


def test_load_documents(spark, tmp_path):
    rows = [
        {"_id": "exp-1", "nombre": "a", "fecha": "2026-03-02", "ejecuciones": [{"modelo_id": "m", "parametros": {"k": [1, 2]}}], "metricas": {"mae": 1.5}},
        {"_id": "exp-2", "nombre": "b", "fecha": "2026-03-03", "ejecuciones": [], "metricas": {}},
    ]
    (tmp_path / "d.json").write_text(json.dumps(rows))
    docs = load_documents(spark, str(tmp_path / "d.json"))
    assert docs.where(q.has_metric("mae")).count() == 1
    assert unwind(docs, "ejecuciones").count() == 1
    assert docs.where(arrays.is_empty("ejecuciones")).count() == 1
    assert docs.select(F.max("fecha")).first()[0].isoformat() == "2026-03-03T00:00:00"


def test_one_document_however_long(spark):
    """A third of the children share one parent: one document, and element questions that gather nothing."""
    children = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("padre"), F.col("id").alias("hijo")
    )
    nested = nest(children, ["padre"], ["hijo"], "hijos", ["hijo"]).cache()
    assert nested.count() == nested.select("padre").distinct().count()
    assert nested.where("padre = 0").select(F.size("hijos")).first()[0] == 10_000
    back = unwind(nested, "hijos", "x").select("padre", "x.hijo")
    assert back.exceptAll(children).isEmpty() and back.count() == children.count()
    met = elements_meet(children, ["padre"], F.col("hijo") == 3, F.col("hijo") == 2997).collect()
    assert [r.padre for r in met] == [0]
    assert elements_meet(children, ["padre"], F.lit(None).cast("boolean")).isEmpty()
    plan = elements_meet(children, ["padre"], F.col("hijo") > 3)._jdf.queryExecution().toString()
    assert "collect_list" not in plan
    first = first_element(children, ["padre"], F.col("hijo") > 10, ["hijo"], ["hijo"]).where("padre = 0").first()
    assert first.hijo == 12


def test_values_without_a_name_are_left_out(spark):
    rows = spark.createDataFrame([(1, "a", 1.0, 1), (1, None, 2.0, 2), (1, "a", 3.0, 3)], "k int, n string, v double, id int")
    assert value_map(rows, ["k"], "n", "v", "m", "id").first()["m"] == {"a": 3.0}


def test_lookup_without_match_is_empty(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([(1, "x")], "b int, v string")
    found = {r["a"]: len(r["vs"]) for r in lookup(left, right, "a", "b", "vs", ["v"], ["v"]).collect()}
    assert found == {1: 1, 2: 0}

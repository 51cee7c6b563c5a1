"""Questions on the registry against answers worked out in plain Python."""

from collections import Counter

import fixture as fx
import pytest
from pyspark.sql import functions as F

from tamizal.plans import registry_queries as q


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_joins(registry):
    per_experiment = Counter(m["experimento_id"] for m in fx.table("metricas"))
    assert q.metrics_by_experiment(registry).count() == len(fx.table("metricas"))
    assert q.full_path(registry).count() == sum(per_experiment[e] for e, _ in fx.runs())
    assert q.datasets_by_user(registry).count() == fx.DATASETS
    assert q.experiments_by_dataset(registry).count() == fx.EXPERIMENTS
    assert q.models_by_experiment(registry).count() == len(fx.runs())
    owning, used = {d["usuario_id"] for d in fx.table("datasets")}, {e["dataset_id"] for e in fx.table("experimentos")}
    assert rows(q.users_without_datasets(registry), "usuario") == sorted((n,) for i, n in fx.names("usuarios").items() if i not in owning)
    assert rows(q.datasets_without_experiments(registry), "dataset") == sorted((n,) for i, n in fx.names("datasets").items() if i not in used)
    assert len(owning) < fx.USERS and len(used) < fx.DATASETS


def test_zero_counts(registry):
    owned = Counter(d["usuario_id"] for d in fx.table("datasets"))
    want = sorted(((n, owned[i]) for i, n in fx.names("usuarios").items()), key=lambda r: (-r[1], r[0]))
    assert rows(q.datasets_per_user(registry), "usuario", "cantidad_datasets") == want and want[-1][1] == 0
    tried = Counter(e["dataset_id"] for e in fx.table("experimentos"))
    some = sorted(((n, tried[i]) for i, n in fx.names("datasets").items() if tried[i]), key=lambda r: (-r[1], r[0]))
    assert rows(q.experiments_per_dataset(registry, 1), "dataset", "cantidad_experimentos") == some
    assert len(rows(q.datasets_of_users_with_counts(registry), "dataset")) == fx.DATASETS


def test_metric_statistics(registry):
    found = {r["metrica"]: (round(r["promedio"], 9), float(r["minimo"]), float(r["maximo"]), r["cantidad_registros"]) for r in q.metric_statistics(registry).collect()}
    assert found == {n: (round(fx.mean(v), 9), min(v), max(v), len(v)) for n, v in fx.by_metric().items()}


def test_metric_by_model(registry):
    accuracy, per_model = fx.value_of("accuracy"), {}
    for e, m in fx.runs():
        if e in accuracy:
            per_model.setdefault(m, []).append(accuracy[e])
    found = [(r["modelo"], round(r["accuracy_promedio"], 9), r["cantidad"]) for r in q.metric_by_model(registry).collect()]
    want = sorted(((-fx.mean(v), m, len(v)) for m, v in per_model.items()))
    assert found == [(fx.names("modelos")[m], round(-a, 9), n) for a, m, n in want]


def test_subqueries_and_windows(registry):
    metrics, accuracy = fx.table("metricas"), fx.value_of("accuracy")
    above = sorted((m for m in metrics if m["nombre"] == "accuracy" and m["valor"] > fx.mean(accuracy.values())), key=lambda m: (-m["valor"], m["id"]))
    assert rows(q.metrics_above_mean(registry), "experimento_id") == [(m["experimento_id"],) for m in above]
    assert q.models_used(registry).count() == len({m for _, m in fx.runs()}) < fx.MODELS
    values = sorted((accuracy[e] for e, _ in fx.runs() if e in accuracy), reverse=True)
    places = {v: i for i, v in enumerate(sorted(set(values), reverse=True), start=1)}
    assert [r[0] for r in q.metric_dense_rank(registry).select("ranking").collect()] == [places[v] for v in values]
    positions = rows(q.metric_positions(registry), "metrica", "posicion_en_su_metrica")
    assert positions == [(n, i) for n, v in sorted(fx.by_metric().items()) for i in range(1, len(v) + 1)]
    means = {(r["metrica"], round(r["promedio_de_la_metrica"], 9)) for r in q.metric_against_mean(registry).collect()}
    assert means == {(n, round(fx.mean(v), 9)) for n, v in fx.by_metric().items()}
    assert [r[0] for r in rows(q.model_ranking(registry), "ranking")] == list(range(1, len(values) + 1))
    best = max(accuracy, key=lambda e: (accuracy[e], -e))
    assert rows(q.best_metric(registry), "experimento") == [(fx.names("experimentos")[best],)]
    done = {e["id"] for e in fx.table("experimentos") if e["finalizado"] == "true"}
    assert q.models_in_finished_experiments(registry).count() == len({r for r in fx.runs() if r[0] in done})
    sizes = sorted((d["cantidad_registros"] for d in fx.table("datasets")), reverse=True)
    assert [r[0] for r in rows(q.datasets_by_size(registry), "cantidad_registros")] == sizes
    groups = {}
    for m in metrics:
        groups.setdefault((m["fecha_registro"][:10], m["nombre"]), []).append(m["valor"])
    found = {(str(r["fecha"]), r["metrica"]): (r["promedio"], r["mediciones"]) for r in q.mean_by_date_and_metric(registry).collect()}
    assert found == {k: (round(fx.mean(v) + 1e-12, 4), len(v)) for k, v in groups.items()}


def test_views(spark, registry):
    assert q.experiment_summary(registry).count() == fx.EXPERIMENTS
    assert q.experiment_model_summary(registry).count() == len(fx.runs())
    assert q.full_case_view(registry).count() == q.full_path(registry).count()
    owners = Counter(fx.owner_of_experiment().values())
    who = owners.most_common(1)[0][0]
    assert spark.sql(f"SELECT count(*) FROM vw_experimentos_resumen WHERE usuario = '{fx.names('usuarios')[who]}'").first()[0] == owners[who]


def test_json(registry):
    import json

    held = {(r["experimento_id"], r["modelo_id"]): json.loads(r["parametros_jsonb"]) for r in fx.table("experimentos_modelos")}

    def keys(test):
        return sorted((e,) for (e, _), p in held.items() if test(p))

    assert sorted(rows(q.parameter(registry, "rule"), "experimento_id", "rule")) == sorted((e, p["rule"]) for (e, _), p in held.items() if "rule" in p)
    assert sorted(rows(q.runs_with_parameter(registry, "cut"), "experimento_id")) == keys(lambda p: "cut" in p)
    assert sorted(rows(q.runs_containing(registry, '{"rule": "gini"}'), "experimento_id")) == keys(lambda p: p.get("rule") == "gini")
    assert sorted(rows(q.runs_containing(registry, {"layers": [2]}), "experimento_id")) == keys(lambda p: 2 in p.get("layers", []))
    assert sorted(rows(q.runs_containing(registry, {"ridge": True}), "experimento_id")) == keys(lambda p: p.get("ridge") is True)
    assert rows(q.runs_containing(registry, {"depth": "3"}), "experimento_id") == []


def test_single_table(registry):
    d, e, m = registry["datasets"], registry["experimentos"], registry["metricas"]
    assert d.where("cantidad_registros > 1000").count() == sum(r["cantidad_registros"] > 1000 for r in fx.table("datasets"))
    assert e.where("NOT finalizado").count() == fx.EXPERIMENTS // 5
    first = sorted((r for r in fx.table("metricas") if r["experimento_id"] == 1), key=lambda r: -r["valor"])[:2]
    assert [r[0] for r in m.where("experimento_id = 1").orderBy(F.desc("valor")).limit(2).select("nombre").collect()] == [r["nombre"] for r in first]


@pytest.mark.parametrize("name", [n for n in dir(q) if n.startswith(("datasets_", "experiments_", "models_", "metric"))])
def test_every_query_has_columns(registry, name):
    if callable(getattr(q, name)):
        assert getattr(q, name)(registry).columns


def test_flat_files_load_typed(spark, registry, incoming):
    from tamizal.sources.registry import load_flat

    for name, df in registry.items():
        loaded = load_flat(spark, f"{incoming}/lote={fx.BATCH_ONE}/{name}.csv", name)
        assert [f.dataType for f in loaded.schema] == [f.dataType for f in df.schema], name
        assert loaded.count() == df.count()
    active = sum(u["activo"] == "true" for u in fx.table("usuarios"))
    assert load_flat(spark, f"{incoming}/lote={fx.BATCH_ONE}/usuarios.csv", "usuarios").where("activo").count() == active

"""The two batches from text files to the published warehouse."""

from pathlib import Path

import fixture
import pytest
from pyspark.sql import functions as F

from tamizal.operators import quality
from tamizal.plans import access_queries, gold, medallion
from tamizal.plans.entities import ENTITIES, levels
from tamizal.sources import bronze, records
from tamizal.sources.publish import current_folder, current_version, publish, read_published, retire

SUMMARY = fixture.totals()
METRIC_NAMES = {1: "accuracy", 2: "precision", 3: "recall", 5: "mae", 6: "loss"}
DAYS = {m["fecha_registro"][:10] for m in fixture.table("metricas")} | {"2025-07-11"}
DATES = sorted(int(d.replace("-", "")) for d in DAYS | {e["fecha"] for e in fixture.table("experimentos")} | {"2025-07-11"})
EXPECTED = {
    "fact_metricas_experimentos": SUMMARY["metricas"][1], "bridge_experimento_modelo": SUMMARY["experimentos_modelos"][1],
    "dim_usuario": SUMMARY["usuarios"][1], "dim_dataset": SUMMARY["datasets"][1], "dim_experimento": SUMMARY["experimentos"][1],
    "dim_modelo": SUMMARY["modelos"][1], "dim_fecha": len(DATES), "dim_metrica": len(METRIC_NAMES),
}
BATCHES = [fixture.BATCH_ONE, fixture.BATCH_TWO]


@pytest.fixture(scope="module")
def lake(spark, incoming, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    medallion.run(spark, incoming, root, BATCHES, "v1", EXPECTED)
    return root


def test_levels():
    assert levels(*ENTITIES) == [
        ["usuarios", "tipos_fuente", "tipos_modelo"], ["datasets", "modelos"], ["experimentos"], ["experimentos_modelos", "metricas"],
    ]


def test_summary_and_codes(spark, lake):
    found = read_published(spark, f"{lake}/silver", "resumen").collect()
    assert {r["entidad"]: (r["recibidas"], r["aceptadas"], r["rechazadas"]) for r in found} == SUMMARY
    rejected = read_published(spark, f"{lake}/silver", "rechazos")
    assert {r["codigo_error"]: r["cantidad"] for r in quality.code_distribution(rejected).collect()} == fixture.defects()
    assert len(fixture.defects()) == 13  # every code there is


def test_each_reject_has_its_line_and_evidence(spark, lake):
    found = {(r["entidad"], r["numero_fila"]): (r["codigo_error"], r["evidencia_original"]) for r in read_published(spark, f"{lake}/silver", "rechazos").collect()}
    want = {(e, i): code for e, rows in fixture.BATCH_TWO_ROWS.items() for i, (_, code) in enumerate(rows, start=2) if code}
    assert {k: v[0] for k, v in found.items()} == want
    row = next(i for i, (r, _) in enumerate(fixture.BATCH_TWO_ROWS["usuarios"], start=2) if r[1] == "Vigía Cuatro")
    assert found[("usuarios", row)][1] == '{"id":"15","nombre":"Vigía Cuatro","email":null,"activo":"no","fecha_alta":"2025-07-09T07:31:00Z"}'
    listed = quality.reject_listing(read_published(spark, f"{lake}/silver", "rechazos")).collect()
    assert [(r["entidad"], r["numero_fila"]) for r in listed] == sorted(want)


def test_accepted_values(spark, lake):
    new = fixture.USERS + 1
    user = read_published(spark, f"{lake}/silver", "usuarios").where(F.col("id") == new).first()
    assert (user["nombre"], user["email"], user["activo"], user["numero_fila"]) == ("Vigía Uno", "vigia@cielo.example", True, 2)
    assert user["lote_id"] == fixture.BATCH_TWO and user["archivo_origen"].endswith("usuarios.csv")
    assert read_published(spark, f"{lake}/silver", "modelos").where(F.col("id") == fixture.MODELS + 1).first()["version"] == "v2"
    first = len(fixture.BATCH_ONE_ROWS["metricas"])
    values = {r["id"]: (r["nombre"], str(r["valor"])) for r in read_published(spark, f"{lake}/silver", "metricas").where(F.col("id") > first).collect()}
    assert values == {first + 1: ("accuracy", "0.625000"), first + 2: ("loss", "0.375000")}


def test_warehouse(spark, lake):
    tables = {t: read_published(spark, f"{lake}/gold", t) for t in [*EXPECTED, "control_cargas"]}
    balance = {r["lote_id"]: (r["filas_aceptadas"], r["filas_rechazadas"]) for r in tables["control_cargas"].collect()}
    rejected = sum(fixture.defects().values())
    assert balance == {
        fixture.BATCH_ONE: (sum(map(len, fixture.BATCH_ONE_ROWS.values())), 0),
        fixture.BATCH_TWO: (sum(map(len, fixture.BATCH_TWO_ROWS.values())) - rejected, rejected),
    }
    assert [r["cantidad"] for r in gold.integrity_controls(tables).collect()] == [0, 0, 0]
    assert sorted(map(tuple, tables["dim_metrica"].collect())) == sorted(METRIC_NAMES.items())
    assert sorted(r["fecha_key"] for r in tables["dim_fecha"].collect()) == DATES
    per_dataset = {}
    experiments, accuracy, owner = fixture.table("experimentos"), fixture.value_of("accuracy"), {d["id"]: d["usuario_id"] for d in fixture.table("datasets")}
    for e in experiments:
        if e["id"] in accuracy:
            per_dataset.setdefault(e["dataset_id"], []).append(accuracy[e["id"]])
    want = {(fixture.names("usuarios")[owner[d]], fixture.names("datasets")[d]): round(fixture.mean(v) + 1e-12, 4) for d, v in per_dataset.items()}
    want["Vigía Uno", "Noche larga"] = 0.625
    assert {(r["propietario"], r["dataset"]): r["accuracy_promedio"] for r in gold.accuracy_by_owner(tables).collect()} == want
    groups = {(m["fecha_registro"][:10], m["nombre"]) for m in fixture.table("metricas")}
    assert gold.mean_by_date_and_metric(tables).count() == len(groups) + 2
    listed = {r["experimento"]: (r["modelos_participantes"], r["modelos"]) for r in gold.models_by_experiment(tables).collect()}
    models = {}
    for e, m in fixture.runs():
        models.setdefault(fixture.names("experimentos")[e], []).append(fixture.names("modelos")[m])
    models["Ensayo final"] = ["Lente 9"]
    assert listed == {e: (len(m), ", ".join(sorted(m))) for e, m in models.items()}
    folder = Path(current_folder(spark, f"{lake}/gold"))
    assert folder.parent.name == "version=v1" and (folder / "fact_metricas_experimentos" / "fecha_key=20250711").exists()
    parsed = tables["bridge_experimento_modelo"].select(F.try_variant_get("parametros_jsonb", "$.mix", "double").alias("t"))
    assert parsed.where("t = 0.5").count() == 1


def test_second_run_gives_the_same_rows(spark, lake, incoming):
    before = {t: sorted(map(str, read_published(spark, f"{lake}/gold", t).collect())) for t in EXPECTED}
    medallion.run(spark, incoming, lake, BATCHES, "v2", EXPECTED)
    assert current_version(spark, f"{lake}/gold") == "v2"
    assert before == {t: sorted(map(str, read_published(spark, f"{lake}/gold", t).collect())) for t in EXPECTED}


def test_a_run_leaves_no_intermediate_tables(spark, incoming, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "scratch"
    before = set(shared.iterdir())
    medallion.run(spark, incoming, str(tmp_path), BATCHES, "a", EXPECTED)
    with pytest.raises(quality.QualityGateError):
        medallion.run(spark, incoming, str(tmp_path), BATCHES, "b", {"dim_usuario": 0})
    assert set(shared.iterdir()) == before
    for version in ("c", "d"):
        publish(spark, str(tmp_path / "w"), version, {"t": spark.range(3)}, lambda _: None)
    current = current_folder(spark, str(tmp_path / "w"))
    assert [f.split("/")[0] for f in retire(spark, str(tmp_path / "w"), 1)] == ["version=c"]
    assert current_folder(spark, str(tmp_path / "w")) == current and read_published(spark, str(tmp_path / "w"), "t").count() == 3


def test_refused_version_leaves_the_old_one(spark, tmp_path):
    def refuse(_):
        raise quality.QualityGateError("no")

    root = str(tmp_path / "w")
    publish(spark, root, "a", {"t": spark.range(3)}, lambda _: None)
    with pytest.raises(quality.QualityGateError):
        publish(spark, root, "b", {"t": spark.range(9)}, refuse)
    assert current_version(spark, root) == "a" and read_published(spark, root, "t").count() == 3
    with pytest.raises(quality.QualityGateError):  # the current version itself, run again and refused
        publish(spark, root, "a", {"t": spark.range(50)}, refuse)
    assert read_published(spark, root, "t").count() == 3
    publish(spark, root, "a", {"t": spark.range(5)}, lambda _: None)
    assert current_version(spark, root) == "a" and read_published(spark, root, "t").count() == 5


def test_refused_run_leaves_silver_too(spark, lake, incoming):
    before = current_folder(spark, f"{lake}/silver"), current_folder(spark, f"{lake}/gold")
    with pytest.raises(quality.QualityGateError):
        medallion.run(spark, incoming, lake, BATCHES, current_version(spark, f"{lake}/gold"), {"dim_usuario": 99})
    assert before == (current_folder(spark, f"{lake}/silver"), current_folder(spark, f"{lake}/gold"))
    assert read_published(spark, f"{lake}/silver", "usuarios").count() == SUMMARY["usuarios"][1]


def test_gates(spark):
    with pytest.raises(quality.QualityGateError, match="expected 4, found 3"):
        quality.require_counts({"t": spark.range(3)}, {"t": 4})
    ok = spark.range(1).select(quality.gate_column(F.col("id") == 0, "id is %d", F.col("id")).alias("r"))
    assert ok.first()["r"] == "CONTROLES_OK"
    with pytest.raises(Exception, match="id is 0"):
        spark.range(1).select(quality.gate_column(F.col("id") == 1, "id is %d", F.col("id"))).collect()


def test_landing_rules(spark, incoming, tmp_path):
    target = str(tmp_path / "bronze")
    with pytest.raises(bronze.LandingError, match="not allowed"):
        bronze.land_batch(spark, incoming, target, fixture.BATCH_ONE, allowed=[fixture.BATCH_TWO])
    with pytest.raises(bronze.LandingError, match="no such"):
        bronze.land_batch(spark, incoming, target, "lote_99")
    short = tmp_path / "short"
    fixture.write_csv(short / "lote=x" / "usuarios.csv", "usuarios", [])
    with pytest.raises(bronze.LandingError, match="lacks"):
        bronze.land_batch(spark, str(short), target, "x")
    Path(target, "usuarios", f"lote={fixture.BATCH_TWO}").mkdir(parents=True)
    Path(target, "usuarios", f"lote={fixture.BATCH_TWO}", "part-0.parquet").write_bytes(b"")
    with pytest.raises(bronze.LandingError, match="half landed"):
        bronze.land_batch(spark, incoming, target, fixture.BATCH_TWO)


def test_line_numbers_over_many_blocks(spark, tmp_path):
    """A file cut into many splits still numbers its lines 2, 3, 4, .."""
    rows = [(i, f"nombre {i}") for i in range(1, 4001)]
    fixture.write_csv(tmp_path / "lote=a" / "tipos_fuente.csv", "tipos_fuente", rows)
    fixture.write_csv(tmp_path / "lote=b" / "tipos_fuente.csv", "tipos_fuente", rows[:7])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = bronze.read_batches(spark, str(tmp_path), "tipos_fuente").cache()
        assert found.where("lote_id = 'a'").count() == 4000
        assert found.where(F.col("numero_fila") != F.col("id").cast("int") + 1).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_batch_profile(spark, incoming):
    from tamizal.operators.profile import column_profile, rows_per_source
    from tamizal.operators.relational import visible

    frames = {e: bronze.read_batches(spark, incoming, e) for e in ("usuarios", "metricas")}
    found = {(r["entidad"], r["lote_id"]): r["filas"] for r in rows_per_source(frames).collect()}
    assert found[("metricas", fixture.BATCH_TWO)] == len(fixture.BATCH_TWO_ROWS["metricas"]) and found[("usuarios", fixture.BATCH_ONE)] == fixture.USERS
    shown = frames["usuarios"].where(F.col("lote_id") == fixture.BATCH_TWO).select(visible("nombre").alias("n"), visible("email", "NULL").alias("e"))
    assert {tuple(r) for r in shown.collect()} >= {("[  Vigía   Uno ]", "[ VIGIA@Cielo.Example]"), ("[Vigía Cuatro]", "[NULL]")}
    profiled = {r["columna"]: r for r in column_profile(frames["metricas"]).collect()}
    assert profiled["id"]["filas"] == SUMMARY["metricas"][0] and profiled["nombre"]["distintos_aprox"] == len(set(fixture.by_metric()) | {r[2] for r, _ in fixture.BATCH_TWO_ROWS["metricas"]})


def _odd_records(path, rows, seed, breaks):
    """A CSV file by Python's writer, with blank lines, and rows of a field too many or too few (true in ``rows``)."""
    import csv
    import io
    import random

    rng, out = random.Random(seed), io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=breaks)
    writer.writerow(["id", "nombre"])
    for number, (row, malformed) in enumerate(rows):
        writer.writerow([*row, "sobra"] if malformed and number % 2 else row[:1] if malformed else row)
        if rng.random() < 0.05:
            out.write(breaks)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")


def test_records_over_many_blocks(spark, tmp_path):
    """Quoted line breaks, quotes and commas over splits of a few hundred bytes: every record, once, at its number."""
    import random

    rng = random.Random(3)
    odd = ["x", "a,b", "uno\ndos", 'una "cita"', "\n\n", '"', '","\n",', "é\n", "\r\n,", " "]
    want = {}
    for name, breaks, choice in (("a", "\n", odd), ("b", "\r\n", odd), ("c", "\n", odd[:2])):
        rows = [((str(i), rng.choice(choice)), i % 31 == 30) for i in range(300)]
        _odd_records(tmp_path / f"{name}.csv", rows, 1, breaks)
        want.update({(f"{name}.csv", n): (None if bad else row) for n, (row, bad) in enumerate(rows, start=2)})
    settings = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = records.read_records(spark, f"{tmp_path}/*.csv", ["id", "nombre"]).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(found) == len(want)
    for r in found:
        row = want[r["archivo_origen"].rsplit("/", 1)[1], r["numero_fila"]]
        assert (r["registro_invalido"] is not None) if row is None else (r["id"], r["nombre"], r["registro_invalido"]) == (*row, None)


def test_refused_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,nombre\n1,"never closed\n2,x\n')
    with pytest.raises(records.RecordError, match="open at the end"):
        records.read_records(spark, f"{tmp_path}/open.csv", ["id", "nombre"])
    (tmp_path / "head.csv").write_text("nombre,id\n1,x\n")
    with pytest.raises(records.RecordError, match="header"):
        records.read_records(spark, f"{tmp_path}/head.csv", ["id", "nombre"])
    (tmp_path / "long.csv").write_text('id,nombre\n1,"' + "y\n" * 400 + '"\n')
    with pytest.raises(records.RecordError, match="record 2 has"):
        records.records(records.read_lines(spark, f"{tmp_path}/long.csv"), most_bytes=300)
    (tmp_path / "bom.csv").write_text("\ufeffid,nombre\n", encoding="utf-8")
    assert records.read_records(spark, f"{tmp_path}/bom.csv", ["id", "nombre"]).isEmpty()


def test_malformed_records_are_rejected_and_take_no_key(spark, tmp_path):
    fixture.write_batches(tmp_path / "in", fixture.BATCH_ONE)
    kinds = tmp_path / "in" / f"lote={fixture.BATCH_ONE}" / "tipos_fuente.csv"
    kinds.write_text(kinds.read_text() + "8\n8,Globo,sobra\n8,Globo\n")
    bronze.land_batch(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), fixture.BATCH_ONE)
    rows = quality.evaluate(bronze.read_bronze(spark, str(tmp_path / "bronze"), "tipos_fuente"), ENTITIES["tipos_fuente"])
    found = {r["numero_fila"]: (r["codigo_error"], r["evidencia_original"]) for r in rows.where("numero_fila > 5").collect()}
    assert found[8] == (None, '{"id":"8","nombre":"Globo"}')
    assert {n: found[n] for n in (6, 7)} == {6: ("MALFORMED_RECORD", '{"registro_invalido":"8"}'), 7: ("MALFORMED_RECORD", '{"registro_invalido":"8,Globo,sobra"}')}


def test_quoted_records_over_many_files(spark, tmp_path):
    """Every file has its header, also when the texts fill more tasks than the ids alone."""
    letters = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.md5(F.concat(F.col("doc_id").cast("string"), i.cast("string")))), "\n")
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("es").alias("lang")).withColumn("text", letters)
    rows.select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["registro"]: (r["filas"], r["ids"], r["letras"], r["lugares"]) for r in access_queries.quoted_records(spark, str(tmp_path)).collect()}
    bad = [i for i in range(1000) if i % 11 == 3 or i % 13 == 5]
    good = 1000 - len(bad)
    assert found == {"con otros campos": (len(bad), sum(bad), None, len(bad)), "entero": (good, sum(range(1000)) - sum(bad), good * (200 * 33 - 1), good)}

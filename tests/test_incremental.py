from pathlib import Path

import fixture
from pyspark.sql import functions as F

from tamizal.streaming import incremental


def test_batches_arrive_one_after_the_other(spark, tmp_path):
    incoming, lake = tmp_path / "in", str(tmp_path / "lake")
    fixture.write_batches(incoming, fixture.BATCH_ONE)
    incremental.ingest_available(spark, str(incoming), lake)
    assert incremental.read_silver(spark, lake, "metricas").count() == len(fixture.BATCH_ONE_ROWS["metricas"])

    fixture.write_batches(incoming, fixture.BATCH_TWO)
    incremental.ingest_available(spark, str(incoming), lake)
    totals = spark.read.parquet(f"{lake}/calidad/resumen").agg(F.sum("recibidas"), F.sum("aceptadas"), F.sum("rechazadas")).first()
    assert tuple(totals) == tuple(map(sum, zip(*fixture.totals().values())))
    found = {(r["entidad"], r["numero_fila"]): r["codigo_error"] for r in spark.read.parquet(f"{lake}/calidad/rechazos").collect()}
    assert found == {(e, i): code for e, rows in fixture.BATCH_TWO_ROWS.items() for i, (_, code) in enumerate(rows, start=2) if code}

    incremental.ingest_available(spark, str(incoming), lake)
    assert incremental.waiting_batches(spark, lake).isEmpty()
    assert len(list(Path(lake, "silver", "usuarios").glob("micro=*"))) == 2


def test_any_order_of_files_gives_one_landing(spark, tmp_path):
    """Files come in three triggers, children before parents and the second batch before the first is whole."""
    whole, incoming, lake, straight = tmp_path / "whole", tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "straight")
    fixture.write_batches(whole)
    order = [fixture.BATCH_ONE, fixture.BATCH_TWO]
    files = sorted(whole.rglob("*.csv"), key=lambda f: (f.name, f.parent.name), reverse=True)
    files.sort(key=lambda f: f.name == "metricas.csv" and f.parent.name.endswith(order[0]))  # one file comes last of all
    for part in (files[:5], files[5:15], files[15:]):
        for file in part:
            target = incoming / file.relative_to(whole)
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(file.read_bytes())
        incremental.ingest_available(spark, str(incoming), lake, order)
        if part is not files[15:] and len(list(incoming.rglob("*.csv"))) < len(files):
            assert not Path(lake, "silver").exists()
            assert {r["lote_id"] for r in incremental.waiting_batches(spark, lake).collect()} <= set(order)
    incremental.ingest_available(spark, str(whole), straight, order)
    for entity in fixture.HEADERS:
        ours, theirs = (incremental.read_silver(spark, at, entity).drop("archivo_origen", "ingerido_en") for at in (lake, straight))
        assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect())), entity
    codes = {r["codigo_error"]: r["count"] for r in spark.read.parquet(f"{lake}/calidad/rechazos").groupBy("codigo_error").count().collect()}
    assert codes == fixture.defects()


def test_records_with_line_breaks_and_surplus_fields_on_the_stream(spark, tmp_path):
    fixture.write_batches(tmp_path / "in", fixture.BATCH_ONE)
    users = tmp_path / "in" / f"lote={fixture.BATCH_ONE}" / "usuarios.csv"
    users.write_text(users.read_text() + '90,"Dos\nlíneas",dos@cielo.example,true,2025-01-01\n91,De más,mas@cielo.example,true,2025-01-01,sobra\n')
    lake = str(tmp_path / "lake")
    incremental.ingest_available(spark, str(tmp_path / "in"), lake)
    found = {r["id"]: r["nombre"] for r in incremental.read_silver(spark, lake, "usuarios").where("id >= 90").collect()}
    assert found == {90: "Dos líneas"}
    rejected = spark.read.parquet(f"{lake}/calidad/rechazos").collect()
    assert [(r["codigo_error"], r["numero_fila"]) for r in rejected] == [("MALFORMED_RECORD", fixture.USERS + 3)]

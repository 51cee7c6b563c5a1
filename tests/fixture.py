"""A made-up observatory's registry in two batches, grown by rules on the key, with its answers in plain Python.

Batch one is clean. Batch two mixes rows in untidy spelling with rows that have one planted defect each;
which defect a row has follows from its place in the list. Expected results are computed from the rows.
"""

from __future__ import annotations

import csv
import json
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

BATCH_ONE, BATCH_TWO = "ronda_1", "ronda_2"

HEADERS = {
    "usuarios": "id nombre email activo fecha_alta",
    "tipos_fuente": "id nombre",
    "datasets": "id usuario_id nombre tipo_fuente_id fuente_detalle cantidad_registros fecha_creacion",
    "tipos_modelo": "id nombre",
    "modelos": "id usuario_id nombre tipo_modelo_id version fecha_creacion",
    "experimentos": "id dataset_id nombre descripcion fecha finalizado",
    "experimentos_modelos": "experimento_id modelo_id parametros resultado parametros_jsonb",
    "metricas": "id experimento_id nombre valor fecha_registro",
}
USERS, DATASETS, MODELS, EXPERIMENTS = 11, 17, 8, 21
SOURCES = ["Telescopio", "Radar", "Libreta", "Boya"]
DETAILS = {"Espejo norte": 1, "Espejo sur": 1, "Antena": 2, "Cuaderno": 3, "Boya vieja": 4}
MODEL_KINDS = ["Árbol", "Red", "Recta"]


def _day(i: int, month: int) -> str:
    return f"2025-{month:02d}-{1 + i * 5 % 27:02d}"


def _accuracy(i: int) -> float:
    return (40 + i * 29 % 53) / 100


def _metrics() -> list[tuple]:
    """Every experiment but each seventh has an accuracy; the rest by divisors of the key."""
    rows: list[tuple] = []
    for i in range(1, EXPERIMENTS + 1):
        values = {} if i % 7 == 0 else {"accuracy": _accuracy(i)}
        if i % 2:
            values["precision"] = (35 + i * 17 % 61) / 100
        if i % 3:
            values["recall"] = (30 + i * 13 % 67) / 100
        if i % 7 == 0:
            values["mae"] = i * 1.375
        for name, value in values.items():
            rows.append((len(rows) + 1, i, name, value, f"{_day(i, 6)}T20:{len(rows) % 60:02d}:00Z"))
    return rows


def _parameters(experiment: int, model: int) -> dict:
    kinds = [{"depth": 2 + experiment % 4, "rule": "gini" if experiment % 2 else "gain"}, {"layers": [experiment % 3 + 1, 4], "cut": round(0.1 + experiment / 40, 3)}, {"ridge": experiment % 5 == 0}]
    return kinds[(model - 1) % len(MODEL_KINDS)]


def _runs() -> list[tuple]:
    pairs = [(e, m) for e in range(1, EXPERIMENTS + 1) for m in sorted({e % (MODELS - 1) + 1, (e * e) % (MODELS - 1) + 1} if e % 3 == 0 else {e % (MODELS - 1) + 1})]
    return [(e, m, ";".join(f"{k}={v}" for k, v in _parameters(e, m).items()), f"r{e}.{m}", json.dumps(_parameters(e, m), separators=(",", ":"))) for e, m in pairs]


def _detail(i: int) -> str:
    return list(DETAILS)[i % len(DETAILS)]


BATCH_ONE_ROWS: dict[str, list[tuple]] = {
    "usuarios": [(i, f"Observadora {chr(64 + i)}", f"obs{i}@cielo.example", "false" if i % 4 == 0 else "true", f"{_day(i, 1)}T08:00:00Z") for i in range(1, USERS + 1)],
    "tipos_fuente": list(enumerate(SOURCES, start=1)),
    "datasets": [(i, 1 + i * i % (USERS - 2), f"Noche {i:02d}", DETAILS[_detail(i)], _detail(i), i * 311 % 2000, f"{_day(i, 2)}T10:30:00Z") for i in range(1, DATASETS + 1)],
    "tipos_modelo": list(enumerate(MODEL_KINDS, start=1)),
    "modelos": [(i, 1 + i * 3 % USERS, f"Lente {i}", 1 + (i - 1) % len(MODEL_KINDS), f"v{1 + i % 3}", f"{_day(i, 3)}T12:00:00Z") for i in range(1, MODELS + 1)],
    "experimentos": [(i, 1 + i * 4 % (DATASETS - 3), f"Ensayo {i:02d}", f"Vuelta {i}", _day(i, 5), "false" if i % 5 == 0 else "true") for i in range(1, EXPERIMENTS + 1)],
    "experimentos_modelos": _runs(),
    "metricas": _metrics(),
}


def _second_batch() -> dict[str, list[tuple[tuple, str | None]]]:
    """(row, code it must get or None); keys go on where batch one ends, and 70 and up are nobody's."""
    u, d, m, e, n = USERS, DATASETS, MODELS, EXPERIMENTS, len(BATCH_ONE_ROWS["metricas"])
    rows: dict[str, list[tuple[tuple, str | None]]] = {
        "usuarios": [
            ((u + 1, "  Vigía   Uno ", " VIGIA@Cielo.Example", "sí", "09/07/2025 07:15:00"), None),
            ((u + 2, " Vigía Dos", "dos@cielo.example ", "0", "2025-07-09 07:20"), None),
            ((u + 3, "", "tres@cielo.example", "no", "2025-07-09T07:30:00Z"), "MISSING_REQUIRED"),
            ((u + 4, "Vigía Cuatro", "", "no", "2025-07-09T07:31:00Z"), "MISSING_REQUIRED"),
            ((u + 1, "Otra Vigía", "otra@cielo.example", "true", "2025-07-09T07:32:00Z"), "DUPLICATE_KEY"),
            ((u + 5, "Vigía Cinco", "cinco@cielo.example", "tal vez", "2025-07-09T07:33:00Z"), "INVALID_BOOLEAN"),
        ],
        "tipos_fuente": [((5, "  Satélite "), None), ((2, "Radar bis"), "DUPLICATE_KEY")],
        "tipos_modelo": [((4, " Mezcla"), None)],
        "datasets": [((d + 1, u + 1, " Noche  larga ", 5, " disco ", 77, "10/07/2025 06:00:00"), None)],
        "modelos": [((m + 1, u + 2, " Lente 9 ", 4, "  V2 ", "10/07/2025 06:30:00"), None)],
        "experimentos": [((e + 1, d + 1, "Ensayo  final", "Última.", "11/07/2025", "SI"), None), ((e + 2, 1, "Ensayo extra", "Más.", "2025/7/11", "f"), None)],
        "experimentos_modelos": [((e + 1, m + 1, "mix=0.5", "bien", '{"mix":0.5}'), None)],
        "metricas": [((n + 1, e + 1, "  Accuracy", "0,625", "11/07/2025 21:00:00"), None), ((n + 2, e + 1, "LOSS ", "37,5 %", "2025-07-11 21:01"), None)],
    }
    bad_keys = iter(range(70, 99))
    for code, user, kind, size in (("UNKNOWN_USER", 98, 1, 5), ("UNKNOWN_SOURCE_TYPE", 1, 98, 5), ("NEGATIVE_QUANTITY", 1, 1, -1), ("UNKNOWN_USER", u + 3, 1, 5)):
        rows["datasets"].append(((next(bad_keys), user, "Noche rara", kind, "x", size, "2025-07-10T06:10:00Z"), code))
    for code, user, kind in (("UNKNOWN_MODEL_TYPE", 1, 98), ("UNKNOWN_USER", 98, 1)):
        rows["modelos"].append(((next(bad_keys), user, "Lente rara", kind, "v1", "2025-07-10T06:40:00Z"), code))
    for code, dataset, day, done in (("UNKNOWN_DATASET", 98, "2025-07-11", "true"), ("INVALID_DATE", 1, "30/02/2025", "true"), ("INVALID_BOOLEAN", 1, "2025-07-11", "casi"), ("INVALID_DATE", 2, "2025-13-01", "no")):
        rows["experimentos"].append(((next(bad_keys), dataset, "Ensayo raro", "No.", day, done), code))
    for code, experiment, model in (("UNKNOWN_MODEL", e + 1, 98), ("DUPLICATE_KEY", e + 1, m + 1)):
        rows["experimentos_modelos"].append(((experiment, model, "", "", "{}"), code))
    for code, experiment, name, value, day in (
        ("UNKNOWN_EXPERIMENT", 98, "recall", "0.5", "2025-07-11T21:10:00Z"), ("INVALID_RANGE", 1, "precision", "140%", "2025-07-11T21:11:00Z"),
        ("INVALID_RANGE", 1, "mae", "-3", "2025-07-11T21:12:00Z"), ("UNKNOWN_METRIC_CATEGORY", 1, "brillo", "0.5", "2025-07-11T21:13:00Z"), ("INVALID_DATE", 1, "recall", "0.5", "ayer"),
    ):
        rows["metricas"].append(((next(bad_keys), experiment, name, value, day), code))
    return rows


BATCH_TWO_ROWS = _second_batch()

# ---------------------------------------------------------------------- answers in plain Python


def table(name: str) -> list[dict]:
    """Batch one as dictionaries."""
    return [dict(zip(HEADERS[name].split(), row)) for row in BATCH_ONE_ROWS[name]]


def accepted_two(entity: str) -> int:
    return sum(code is None for _, code in BATCH_TWO_ROWS[entity])


def totals() -> dict[str, tuple[int, int, int]]:
    """Received, accepted and rejected of both batches by entity."""
    out = {}
    for entity, first in BATCH_ONE_ROWS.items():
        second, good = len(BATCH_TWO_ROWS[entity]), accepted_two(entity)
        out[entity] = (len(first) + second, len(first) + good, second - good)
    return out


def defects() -> Counter:
    return Counter(code for rows in BATCH_TWO_ROWS.values() for _, code in rows if code)


def by_metric() -> dict[str, list[float]]:
    out: dict[str, list[float]] = defaultdict(list)
    for row in table("metricas"):
        out[row["nombre"]].append(row["valor"])
    return out


def mean(values) -> float:
    exact = [Fraction(str(v)) for v in values]
    return float(sum(exact) / len(exact))


def value_of(name: str) -> dict[int, float]:
    """The metric's value by experiment."""
    return {row["experimento_id"]: row["valor"] for row in table("metricas") if row["nombre"] == name}


def names(entity: str) -> dict[int, str]:
    return {row["id"]: row["nombre"] for row in table(entity)}


def runs() -> list[tuple[int, int]]:
    return [(row["experimento_id"], row["modelo_id"]) for row in table("experimentos_modelos")]


def owner_of_experiment() -> dict[int, int]:
    owners = {row["id"]: row["usuario_id"] for row in table("datasets")}
    return {row["id"]: owners[row["dataset_id"]] for row in table("experimentos")}


def code(prefix: str, key: int) -> str:
    return f"{prefix}-{key:03d}"


# ----------------------------------------------------------------------------------- as files


def write_csv(path: Path, entity: str, rows: list[tuple]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(HEADERS[entity].split())
        writer.writerows(rows)


def write_batches(root: Path, *batches: str) -> None:
    chosen = batches or (BATCH_ONE, BATCH_TWO)
    for entity in HEADERS:
        if BATCH_ONE in chosen:
            write_csv(root / f"lote={BATCH_ONE}" / f"{entity}.csv", entity, BATCH_ONE_ROWS[entity])
        if BATCH_TWO in chosen:
            write_csv(root / f"lote={BATCH_TWO}" / f"{entity}.csv", entity, [row for row, _ in BATCH_TWO_ROWS[entity]])


def registry(spark) -> dict:
    """Batch one as typed tables."""
    from pyspark.sql import functions as F

    from tamizal.functions.cleaning import safe_timestamp
    from tamizal.sources.schemas import REGISTRY

    out = {}
    for name, rows in BATCH_ONE_ROWS.items():
        columns = HEADERS[name].split()
        text = spark.createDataFrame([tuple(str(v) for v in row) for row in rows], ", ".join(f"{n} string" for n in columns))

        def typed(field):
            kind = field.dataType.typeName()
            if kind == "variant":
                return F.parse_json(field.name)
            if kind == "timestamp_ntz":
                return safe_timestamp(field.name)
            return F.col(field.name).cast(field.dataType)

        out[name] = text.select(*[typed(f).alias(f.name) for f in REGISTRY[name]]).cache()
    return out

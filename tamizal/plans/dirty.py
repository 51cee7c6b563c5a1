"""Raw text of the eight entities derived from the analytic tables, with defects planted by key.

The select lists use only what Spark SQL and ANSI SQL engines share, so a reference engine can
derive the same text. Batch two sends some keys of batch one again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ONE, BATCH_TWO = "lote_01_inicial", "lote_02_nuevos"


def _pad(number: str, width: int = 2) -> str:
    return f"lpad(CAST({number} AS STRING), {width}, '0')"


def _date_text(key: str, ts: str, time: bool, bad: str) -> str:
    """Three notations in turn; keys where ``bad`` holds get a day that does not exist."""
    y, m, d = f"CAST(year({ts}) AS STRING)", _pad(f"month({ts})"), _pad(f"day({ts})")
    clock = f"{_pad(f'hour({ts})')} || ':' || {_pad(f'minute({ts})')} || ':' || {_pad(f'second({ts})')}"
    iso_clock, clock = (f" || 'T' || {clock} || 'Z'", f" || ' ' || {clock}") if time else ("", "")
    wrong = "'31/02/2024 09:00:00'" if time else "'31/02/2024'"
    return (
        f"CASE WHEN {bad} THEN {wrong} "
        f"WHEN {key} % 3 = 0 THEN {y} || '-' || {m} || '-' || {d}{iso_clock} "
        f"WHEN {key} % 3 = 1 THEN {d} || '/' || {m} || '/' || {y}{clock} "
        f"ELSE {y} || '/' || {m} || '/' || {d}{clock} END"
    )


def _made_up_date(key: str, bad: str) -> str:
    y, m, d = f"CAST(2022 + {key} % 4 AS STRING)", _pad(f"1 + {key} % 12"), _pad(f"1 + {key} % 28")
    clock = f"{_pad(f'{key} % 24')} || ':' || {_pad(f'{key} % 60')} || ':00'"
    return (
        f"CASE WHEN {bad} THEN '31/02/2024 09:00:00' "
        f"WHEN {key} % 3 = 0 THEN {y} || '-' || {m} || '-' || {d} || 'T' || {clock} || 'Z' "
        f"WHEN {key} % 3 = 1 THEN {d} || '/' || {m} || '/' || {y} || ' ' || {clock} "
        f"ELSE {y} || '/' || {m} || '/' || {d} || ' ' || {clock} END"
    )


def _text(key: str, bad: str | None = None, replacement: str = "''") -> str:
    spaced = f"CASE WHEN {key} % 7 = 2 THEN '  ' || CAST({key} AS STRING) || ' ' ELSE CAST({key} AS STRING) END"
    return spaced if bad is None else f"CASE WHEN {bad} THEN {replacement} ELSE {spaced} END"


# entity -> (source table, {column: expression}, row number, keys sent again in batch two)
_USER = "c_custkey"
_ORDER = "o_orderkey"
_PART = "p_partkey"
_EVENT = "event_id"
_CENTS = "CAST(round(value * 100) AS BIGINT)"
_RATIO = f"lpad(CAST({_CENTS} % 10000 AS STRING), 4, '0')"

DERIVATIONS: dict[str, tuple[str, dict[str, str], str, str | None]] = {
    "usuarios": (
        "customer",
        {
            "id": _text(_USER, f"{_USER} % 41 = 7"),
            "nombre": f"CASE WHEN {_USER} % 40 = 1 THEN '   ' || c_name || '  ' WHEN {_USER} % 40 = 11 THEN replace(c_name, '#', '   ') WHEN {_USER} % 43 = 2 THEN '   ' ELSE c_name END",
            "email": f"CASE WHEN {_USER} % 40 = 4 THEN '' WHEN {_USER} % 40 = 2 THEN ' C' || CAST({_USER} AS STRING) || '@EXAMPLE.COM ' ELSE 'c' || CAST({_USER} AS STRING) || '@example.com' END",
            "activo": f"CASE WHEN {_USER} % 40 = 5 THEN 'quizás' WHEN {_USER} % 7 = 0 THEN 'true' WHEN {_USER} % 7 = 1 THEN 'Sí' WHEN {_USER} % 7 = 2 THEN ' NO ' WHEN {_USER} % 7 = 3 THEN 'f' WHEN {_USER} % 7 = 4 THEN '1' WHEN {_USER} % 7 = 5 THEN 'S' ELSE 'False' END",
            "fecha_alta": _made_up_date(_USER, f"{_USER} % 40 = 6"),
        },
        f"{_USER} + 2",
        f"{_USER} % 50 = 8",
    ),
    "tipos_fuente": (
        "(SELECT DISTINCT substr(o_orderpriority, 1, 1) AS k, substr(o_orderpriority, 3) AS t FROM orders) AS x",
        {"id": "' ' || k", "nombre": "' ' || t || ' '"},
        "CAST(k AS BIGINT) + 1",
        None,
    ),
    "tipos_modelo": (
        "(SELECT DISTINCT CAST(ascii(substr(p_type, 2, 1)) AS BIGINT) AS k, p_type AS t FROM part) AS x",
        {"id": "CAST(k AS STRING)", "nombre": "t || ' '"},
        "k + 1",
        None,
    ),
    "datasets": (
        "orders",
        {
            "id": _text(_ORDER, f"{_ORDER} % 47 = 7"),
            "usuario_id": f"CASE WHEN {_ORDER} % 50 = 5 THEN '999999999' ELSE CAST(o_custkey AS STRING) END",
            "nombre": f"' Dataset ' || CAST({_ORDER} AS STRING)",
            "tipo_fuente_id": f"CASE WHEN {_ORDER} % 50 = 6 THEN '99' ELSE substr(o_orderpriority, 1, 1) END",
            "fuente_detalle": f"CASE WHEN {_ORDER} % 50 = 1 THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END",
            "cantidad_registros": f"CASE WHEN {_ORDER} % 50 = 4 THEN '-10' WHEN {_ORDER} % 50 = 9 THEN 'muchos' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END",
            "fecha_creacion": _date_text(_ORDER, "o_orderdate", True, f"{_ORDER} % 50 = 3"),
        },
        f"{_ORDER} + 2",
        f"{_ORDER} % 50 = 8",
    ),
    "modelos": (
        "part",
        {
            "id": _text(_PART),
            "usuario_id": f"CASE WHEN {_PART} % 50 = 5 THEN '999999999' ELSE CAST(p_size AS STRING) END",
            "nombre": "p_name",
            "tipo_modelo_id": f"CASE WHEN {_PART} % 50 = 6 THEN '999' ELSE CAST(ascii(substr(p_type, 2, 1)) AS STRING) END",
            "version": f"' V' || CAST({_PART} % 5 AS STRING) || ' '",
            "fecha_creacion": _made_up_date(_PART, f"{_PART} % 50 = 3"),
        },
        f"{_PART} + 2",
        f"{_PART} % 50 = 8",
    ),
    "experimentos": (
        "orders",
        {
            "id": _text(_ORDER),
            "dataset_id": f"CASE WHEN {_ORDER} % 50 = 12 THEN '999999999' ELSE CAST({_ORDER} AS STRING) END",
            "nombre": f"'Experimento ' || CAST({_ORDER} AS STRING)",
            "descripcion": f"CASE WHEN {_ORDER} % 2 = 0 THEN '' ELSE 'Pedido  de ' || CAST(o_custkey AS STRING) END",
            "fecha": _date_text(_ORDER, "o_orderdate", False, f"{_ORDER} % 50 = 13"),
            "finalizado": f"CASE WHEN {_ORDER} % 50 = 2 THEN 'quizás' WHEN o_orderstatus = 'F' THEN 'SI' WHEN o_orderstatus = 'O' THEN 'no' ELSE '0' END",
        },
        f"{_ORDER} + 2",
        f"{_ORDER} % 50 = 18",
    ),
    "experimentos_modelos": (
        "(SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem) AS x",
        {
            "experimento_id": "CAST(l_orderkey AS STRING)",
            "modelo_id": "CASE WHEN l_orderkey % 50 = 15 THEN '999999999' ELSE CAST(l_partkey AS STRING) END",
            "parametros": "'linea=' || CAST(l_linenumber AS STRING) || ';criterion=gini'",
            "resultado": "CASE WHEN l_linenumber = 1 THEN ' ' ELSE 'Resultado ' || CAST(l_linenumber AS STRING) END",
            "parametros_jsonb": "CASE WHEN l_linenumber = 7 THEN '{mal' ELSE '{\"linea\":' || CAST(l_linenumber AS STRING) || ',\"criterion\":\"gini\"}' END",
        },
        "(l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey",
        None,
    ),
    "metricas": (
        "events",
        {
            "id": _text(_EVENT, f"{_EVENT} % 53 = 7"),
            "experimento_id": f"CASE WHEN {_EVENT} % 50 = 5 THEN '999999999' ELSE CAST({_EVENT} AS STRING) END",
            "nombre": f"CASE WHEN {_EVENT} % 50 = 6 THEN 'métrica_desconocida' WHEN event_type = 'view' THEN ' Accuracy ' WHEN event_type = 'click' THEN 'PRECISIÓN' "
            f"WHEN event_type = 'signup' THEN 'récall' WHEN event_type = 'error' THEN 'F1_SCORE' WHEN {_EVENT} % 3 = 0 THEN 'loss' ELSE 'mae' END",
            "valor": f"CASE WHEN {_EVENT} % 50 = 4 THEN '-0.10' WHEN {_EVENT} % 50 = 7 THEN '' WHEN {_EVENT} % 50 = 10 THEN '1.5' "
            f"WHEN event_type = 'purchase' THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) || ',25' "
            f"WHEN {_EVENT} % 4 = 1 THEN '0,' || {_RATIO} WHEN {_EVENT} % 4 = 2 THEN CAST({_CENTS} % 100 AS STRING) || '%' ELSE ' 0.' || {_RATIO} END",
            "fecha_registro": _date_text(_EVENT, "ts", True, f"{_EVENT} % 50 = 3"),
        },
        f"{_EVENT} + 2",
        f"{_EVENT} % 50 = 8",
    ),
}


def raw_sql(entity: str) -> str:
    """Text rows with lineage (without the ingestion time), both batches."""
    source, columns, number, again = DERIVATIONS[entity]

    def batch(lote: str, where: str) -> str:
        listed = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
        return (
            f"SELECT {listed}, '{lote}' AS lote_id, 'bronze/lote={lote}/{entity}.csv' AS archivo_origen, "
            f"CAST({number} AS BIGINT) AS numero_fila FROM {source}{where}"
        )

    parts = [batch(BATCH_ONE, "")]
    if again:
        parts.append(batch(BATCH_TWO, f" WHERE {again}"))
    return " UNION ALL ".join(parts)


# rows that one task turns into text and cleans
ROWS_PER_TASK = 100_000


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Rows of ``raw_sql`` with the ingestion time, dealt to tasks by their number.

    Spark cuts a scan by bytes and row groups, so a well compressed table is few tasks however many rows it has.
    """
    text, source = raw_sql(entity), DERIVATIONS[entity][0]
    used = [t for t in ("customer", "orders", "part", "lineitem", "events") if f"FROM {t}" in text]

    def read(table: str) -> str:
        path = f"{sf_dir}/{table}.parquet"
        tasks = -(-spark.read.parquet(path).count() // ROWS_PER_TASK) if table == source else 1
        return f"{table} AS (SELECT {f'/*+ REPARTITION({tasks}) */ ' if tasks > 1 else ''}* FROM parquet.`{path}`)"

    return spark.sql(f"WITH {', '.join(map(read, used))} {text}").withColumn(
        "ingerido_en", F.lit("2026-04-01 00:00:00").cast("timestamp_ntz")
    )

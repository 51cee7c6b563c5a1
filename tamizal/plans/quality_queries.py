"""Silver, quality and warehouse queries over the derived dirty batches, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.operators import quality
from tamizal.plans import dirty, gold
from tamizal.plans.entities import ENTITIES, with_parents
from tamizal.plans.medallion import evaluate_in_order

# --------------------------------------------------------------------------- Spark side


def evaluate_entities(
    spark: SparkSession, sf_dir: str, *names: str, columns: dict[str, list[str]] | None = None, evidence: bool = False
) -> dict[str, DataFrame]:
    """Evaluate ``names`` and what they refer to, parents first.

    Beside keys, references and lineage only ``columns`` are kept, and the rows as received only with ``evidence``.
    """
    done = evaluate_in_order(spark, lambda e: dirty.raw(spark, sf_dir, e), names, columns=columns or {}, evidence=evidence)
    return {n: done[n] for n in ENTITIES if n in names}


def silver_entities(spark: SparkSession, sf_dir: str, *names: str, columns: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Accepted rows of ``names``, with all their columns unless ``columns`` lists those to keep."""
    kept = {n: list(ENTITIES[n].columns) for n in names} if columns is None else columns
    return {n: quality.accepted(df) for n, df in evaluate_entities(spark, sf_dir, *names, columns=kept).items()}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and without the run's own timestamp, so that values compare across engines."""
    fields = [
        F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in df.schema
        if f.name not in ("ingerido_en", "procesado_en")
    ]
    return df.select(*fields)


def _silver(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(silver_entities(spark, sf_dir, name)[name])


def rejects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(quality.rejects(evaluate_entities(spark, sf_dir, *ENTITIES, evidence=True)))


def reject_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_listing(quality.rejects(evaluate_entities(spark, sf_dir, "metricas", evidence=True)))


def error_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.code_distribution(quality.rejects(evaluate_entities(spark, sf_dir, *ENTITIES)))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(evaluate_entities(spark, sf_dir, *ENTITIES))


def load_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(evaluate_entities(spark, sf_dir, *ENTITIES)).withColumn("estado", F.lit("COMPLETADO"))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received = accepted + rejected for every entity, or the job fails."""
    totals = quality.summary(evaluate_entities(spark, sf_dir, "usuarios", "datasets", "metricas"))
    balanced = F.col("recibidas") == F.col("aceptadas") + F.col("rechazadas")
    verdict = quality.gate_column(balanced, "unbalanced: %s", F.col("entidad"))
    return totals.select("entidad", "recibidas", verdict.alias("resultado"))


def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second appearances of a metric key over both batches."""
    rows = evaluate_entities(spark, sf_dir, "metricas")["metricas"]
    return rows.where(F.col("codigo_error") == quality.DUPLICATE_KEY).select("id", "lote_id", "numero_fila")


_gold = silver_entities


def dim_fecha(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _gold(spark, sf_dir, "experimentos", "metricas")
    return gold.dim_fecha(s["experimentos"], s["metricas"])


def dim_usuario(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_usuario(_gold(spark, sf_dir, "usuarios")["usuarios"])


def dim_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _gold(spark, sf_dir, "datasets", "tipos_fuente")
    return gold.dim_dataset(s["datasets"], s["tipos_fuente"])


def dim_experimento(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_experimento(_gold(spark, sf_dir, "experimentos")["experimentos"])


def dim_metrica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_metrica(_gold(spark, sf_dir, "metricas")["metricas"])


def dim_modelo(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _gold(spark, sf_dir, "modelos", "tipos_modelo")
    return gold.dim_modelo(s["modelos"], s["tipos_modelo"])


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.bridge_experimento_modelo(_gold(spark, sf_dir, "experimentos_modelos")["experimentos_modelos"])
    linea = F.try_variant_get("parametros_jsonb", "$.linea", "bigint").alias("linea")
    criterion = F.try_variant_get("parametros_jsonb", "$.criterion", "string").alias("criterion")
    return rows.select("experimento_key", "modelo_key", "parametros", "resultado", linea, criterion, "lote_id")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.fact_metricas_experimentos(_gold(spark, sf_dir, "metricas")["metricas"]))


def integrity_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The controls over a warehouse with planted faults: facts and bridge rows of keys that nobody has, repeated facts."""
    tables = gold.build(_gold(spark, sf_dir, *ENTITIES))
    fact, bridge_rows = tables["fact_metricas_experimentos"], tables["bridge_experimento_modelo"]
    orphans = fact.where("metrica_id_origen % 50 = 0").withColumn("experimento_key", -F.col("experimento_key"))
    repeats = fact.where("metrica_id_origen % 40 = 0")
    astray = bridge_rows.where("experimento_key % 3 = 0").withColumn("modelo_key", -F.col("modelo_key"))
    planted = {
        **tables,
        "fact_metricas_experimentos": fact.unionByName(orphans).unionByName(repeats),
        "bridge_experimento_modelo": bridge_rows.unionByName(astray),
    }
    return gold.integrity_controls(planted)


def olap_mean_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = {"experimentos": ["fecha"], "metricas": ["nombre", "valor", "fecha_registro"]}
    s = _gold(spark, sf_dir, *used, columns=used)
    tables = {
        "dim_fecha": gold.dim_fecha(s["experimentos"], s["metricas"]),
        "dim_metrica": gold.dim_metrica(s["metricas"]),
        "fact_metricas_experimentos": gold.fact_metricas_experimentos(s["metricas"]),
    }
    return gold.mean_by_date_and_metric(tables)


def olap_accuracy_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only entities along the path from fact to owner are judged, with the columns that the question reads."""
    used = {"usuarios": ["nombre"], "tipos_fuente": [], "datasets": ["nombre"], "experimentos": [], "metricas": ["nombre", "valor"]}
    s = _gold(spark, sf_dir, *used, columns=used)
    # the columns that no one reads are absent here, so the dimensions are the parts of gold's that the question names
    datasets = s["datasets"].join(s["tipos_fuente"].select(F.col("id").alias("tipo_fuente_id")), "tipo_fuente_id")
    tables = {
        "dim_metrica": gold.dim_metrica(s["metricas"]),
        "fact_metricas_experimentos": s["metricas"].select(F.col("experimento_id").alias("experimento_key"), gold.metric_key("nombre").alias("metrica_key"), "valor"),
        "dim_dataset": datasets.select(F.col("id").alias("dataset_key"), F.col("usuario_id").alias("usuario_key"), "nombre"),
        "dim_usuario": s["usuarios"].select(F.col("id").alias("usuario_key"), "nombre"),
        "dim_experimento": s["experimentos"].select(F.col("id").alias("experimento_key"), F.col("dataset_id").alias("dataset_key")),
    }
    return gold.accuracy_by_owner(tables)


def olap_models_by_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = {"experimentos": ["nombre"], "modelos": ["nombre"], "experimentos_modelos": [], "tipos_modelo": []}
    s = _gold(spark, sf_dir, *used, columns=used)
    models = s["modelos"].join(s["tipos_modelo"].select(F.col("id").alias("tipo_modelo_id")), "tipo_modelo_id")
    tables = {
        "dim_modelo": models.select(F.col("id").alias("modelo_key"), "nombre"),
        "dim_experimento": s["experimentos"].select(F.col("id").alias("experimento_key"), "nombre"),
        "bridge_experimento_modelo": s["experimentos_modelos"].select(
            F.col("experimento_id").alias("experimento_key"), F.col("modelo_id").alias("modelo_key")
        ),
    }
    return gold.models_by_experiment(tables)


# --------------------------------------------------------------------------- SQL twins


def _text(c: str) -> str:
    """Words of the value joined by one blank; none, no value."""
    return f"nullif(array_to_string(list_filter(string_split_regex({c}, '[[:space:]]+'), lambda w: w <> ''), ' '), '')"


def _int(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '\\s*[+-]?[0-9]{{1,18}}\\s*') THEN CAST({c} AS BIGINT) END"


def _iso(c: str) -> str:
    """Day-first and slashed dates rewritten with the year first and dashes; the rest of the value stays."""
    value = f"regexp_replace(trim({c}), '^([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}})', '\\3-\\2-\\1')"
    return f"regexp_replace({value}, '^([0-9]{{4}})/([0-9]{{2}})/', '\\1-\\2-')"


def _ts(c: str) -> str:
    return f"try_cast({_iso(c)} AS TIMESTAMP)"


def _date(c: str) -> str:
    return f"try_cast({_iso(c)} AS DATE)"


# The words that stand for true and false.
_WORDS = {"true": True, "t": True, "1": True, "si": True, "s": True, "false": False, "f": False, "0": False, "no": False, "n": False}


def _bool(c: str) -> str:
    listed = ", ".join(f"('{word}', {str(meaning).lower()})" for word, meaning in _WORDS.items())
    return f"(SELECT w.meaning FROM (VALUES {listed}) w(word, meaning) WHERE w.word = lower(strip_accents(trim({c}))))"


def _dec(c: str) -> str:
    """Digits with a comma or point, and a percent sign that moves the point by two places."""
    digits = f"replace(regexp_extract(trim({c}), '^([+-]?[0-9]*[.,]?[0-9]+)\\s*%?$', 1), ',', '.')"
    moved = f"CASE WHEN suffix(trim({c}), '%') THEN 0.01 ELSE 1 END"
    return f"CAST(try_cast(nullif({digits}, '') AS DECIMAL(18,6)) * ({moved}) AS DECIMAL(18,6))"


_UNKNOWN = "NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.id = n.{column})"

# entity -> (typed columns, key, [(condition, code)])
SQL_RULES: dict[str, tuple[dict[str, str], str, list[tuple[str, str]]]] = {
    "usuarios": (
        {"id": _int("id"), "nombre": _text("nombre"), "email": f"lower({_text('email')})", "activo": _bool("activo"), "fecha_alta": _ts("fecha_alta")},
        "id",
        [
            ("id IS NULL OR nombre IS NULL OR email IS NULL", "MISSING_REQUIRED"),
            ("veces > 1", "DUPLICATE_KEY"),
            ("activo IS NULL", "INVALID_BOOLEAN"),
            ("fecha_alta IS NULL", "INVALID_DATE"),
        ],
    ),
    "tipos_fuente": (
        {"id": _int("id"), "nombre": _text("nombre")},
        "id",
        [("id IS NULL OR nombre IS NULL", "MISSING_REQUIRED"), ("veces > 1", "DUPLICATE_KEY")],
    ),
    "tipos_modelo": (
        {"id": _int("id"), "nombre": _text("nombre")},
        "id",
        [("id IS NULL OR nombre IS NULL", "MISSING_REQUIRED"), ("veces > 1", "DUPLICATE_KEY")],
    ),
    "datasets": (
        {
            "id": _int("id"), "usuario_id": _int("usuario_id"), "nombre": _text("nombre"), "tipo_fuente_id": _int("tipo_fuente_id"),
            "fuente_detalle": _text("fuente_detalle"), "cantidad_registros": _int("cantidad_registros"), "fecha_creacion": _ts("fecha_creacion"),
        },
        "id",
        [
            ("id IS NULL OR usuario_id IS NULL OR nombre IS NULL OR tipo_fuente_id IS NULL OR cantidad_registros IS NULL", "MISSING_REQUIRED"),
            ("veces > 1", "DUPLICATE_KEY"),
            ("cantidad_registros < 0", "NEGATIVE_QUANTITY"),
            ("fecha_creacion IS NULL", "INVALID_DATE"),
            (_UNKNOWN.format(parent="usuarios", column="usuario_id"), "UNKNOWN_USER"),
            (_UNKNOWN.format(parent="tipos_fuente", column="tipo_fuente_id"), "UNKNOWN_SOURCE_TYPE"),
        ],
    ),
    "modelos": (
        {
            "id": _int("id"), "usuario_id": _int("usuario_id"), "nombre": _text("nombre"), "tipo_modelo_id": _int("tipo_modelo_id"),
            "version": f"lower({_text('version')})", "fecha_creacion": _ts("fecha_creacion"),
        },
        "id",
        [
            ("id IS NULL OR usuario_id IS NULL OR nombre IS NULL OR tipo_modelo_id IS NULL", "MISSING_REQUIRED"),
            ("veces > 1", "DUPLICATE_KEY"),
            ("fecha_creacion IS NULL", "INVALID_DATE"),
            (_UNKNOWN.format(parent="usuarios", column="usuario_id"), "UNKNOWN_USER"),
            (_UNKNOWN.format(parent="tipos_modelo", column="tipo_modelo_id"), "UNKNOWN_MODEL_TYPE"),
        ],
    ),
    "experimentos": (
        {
            "id": _int("id"), "dataset_id": _int("dataset_id"), "nombre": _text("nombre"), "descripcion": _text("descripcion"),
            "fecha": _date("fecha"), "finalizado": _bool("finalizado"),
        },
        "id",
        [
            ("id IS NULL OR dataset_id IS NULL OR nombre IS NULL", "MISSING_REQUIRED"),
            ("veces > 1", "DUPLICATE_KEY"),
            ("fecha IS NULL", "INVALID_DATE"),
            ("finalizado IS NULL", "INVALID_BOOLEAN"),
            (_UNKNOWN.format(parent="datasets", column="dataset_id"), "UNKNOWN_DATASET"),
        ],
    ),
    "experimentos_modelos": (
        {
            "experimento_id": _int("experimento_id"), "modelo_id": _int("modelo_id"), "parametros": _text("parametros"),
            "resultado": _text("resultado"), "parametros_jsonb": _text("parametros_jsonb"),
        },
        "experimento_id, modelo_id",
        [
            ("experimento_id IS NULL OR modelo_id IS NULL", "MISSING_REQUIRED"),
            ("veces > 1", "DUPLICATE_KEY"),
            (_UNKNOWN.format(parent="experimentos", column="experimento_id"), "UNKNOWN_EXPERIMENT"),
            (_UNKNOWN.format(parent="modelos", column="modelo_id"), "UNKNOWN_MODEL"),
        ],
    ),
    "metricas": (
        {
            "id": _int("id"), "experimento_id": _int("experimento_id"), "nombre": f"strip_accents(lower({_text('nombre')}))",
            "valor": _dec("valor"), "fecha_registro": _ts("fecha_registro"),
        },
        "id",
        [
            ("id IS NULL OR experimento_id IS NULL OR nombre IS NULL OR valor IS NULL", "MISSING_REQUIRED"),
            ("veces > 1", "DUPLICATE_KEY"),
            ("fecha_registro IS NULL", "INVALID_DATE"),
            ("nombre NOT IN ('accuracy','precision','recall','f1_score','mae','loss')", "UNKNOWN_METRIC_CATEGORY"),
            ("valor < 0 OR (nombre IN ('accuracy','precision','recall','f1_score') AND valor > 1)", "INVALID_RANGE"),
            (_UNKNOWN.format(parent="experimentos", column="experimento_id"), "UNKNOWN_EXPERIMENT"),
        ],
    ),
}


def ctes(*names: str) -> str:
    """``WITH`` list: e_<entity> holds evaluated rows, s_<entity> accepted ones."""
    parts = []
    for name in with_parents(*names):
        typed, key, rules = SQL_RULES[name]
        evidence = ", ".join(f"{c} := {c}" for c in typed)
        columns = ", ".join(f"{expr} AS {c}" for c, expr in typed.items())
        key_exprs = ", ".join(typed[k] for k in key.split(", "))
        cases = " ".join(f"WHEN {condition} THEN '{code}'" for condition, code in rules)
        parts.append(
            f"r_{name} AS MATERIALIZED ({dirty.raw_sql(name)}), "
            f"n_{name} AS MATERIALIZED (SELECT {columns}, lote_id, archivo_origen, numero_fila, to_json(struct_pack({evidence})) AS evidencia_original, "
            f"row_number() OVER (PARTITION BY {key_exprs} ORDER BY lote_id, numero_fila) AS veces FROM r_{name}), "
            f"e_{name} AS MATERIALIZED (SELECT *, CASE {cases} END AS codigo_error FROM n_{name} n), "
            f"s_{name} AS (SELECT * EXCLUDE (veces, evidencia_original, codigo_error) FROM e_{name} WHERE codigo_error IS NULL)"
        )
    return "WITH " + ", ".join(parts) + " "


def _union(template: str, names=None) -> str:
    return " UNION ALL ".join(template.format(e=n) for n in (names or ENTITIES))


_ALL = tuple(ENTITIES)
_REJECTS = _union(
    "SELECT '{e}' AS entidad, codigo_error, lote_id, archivo_origen, numero_fila, CAST(evidencia_original AS VARCHAR) AS evidencia_original "
    "FROM e_{e} WHERE codigo_error IS NOT NULL"
)
_METRIC_KEY = "CASE nombre WHEN 'accuracy' THEN 1 WHEN 'precision' THEN 2 WHEN 'recall' THEN 3 WHEN 'f1_score' THEN 4 WHEN 'mae' THEN 5 WHEN 'loss' THEN 6 END"
_DATE_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"
_DIM_FECHA = (
    f"SELECT DISTINCT {_DATE_KEY.format(d='fecha')} AS fecha_key, fecha, CAST(year(fecha) AS SMALLINT) AS anio, CAST(month(fecha) AS SMALLINT) AS mes, "
    "CAST(day(fecha) AS SMALLINT) AS dia, CAST(quarter(fecha) AS SMALLINT) AS trimestre "
    "FROM (SELECT fecha FROM s_experimentos UNION SELECT CAST(fecha_registro AS DATE) FROM s_metricas) f"
)
_SUMMARY = _union(
    "SELECT '{e}' AS entidad, COUNT(*) AS recibidas, CAST(count_if(codigo_error IS NULL) AS BIGINT) AS aceptadas, "
    "CAST(count_if(codigo_error IS NOT NULL) AS BIGINT) AS rechazadas FROM e_{e}"
)


def _silver_sql(name: str) -> str:
    columns = ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c == "valor" else c for c in [*SQL_RULES[name][0], "lote_id", "archivo_origen", "numero_fila"]
    )
    return ctes(name) + f"SELECT {columns} FROM s_{name}"


QUERIES: dict[str, tuple[Callable, str | None]] = {
    **{f"silver_{name}": (_silver(name), _silver_sql(name)) for name in ENTITIES},
    "rejects_all": (rejects_all, ctes(*_ALL) + _REJECTS),
    "reject_listing": (
        reject_listing,
        ctes("metricas")
        + "SELECT 'metricas' AS entidad, codigo_error, lote_id, numero_fila, CAST(evidencia_original AS VARCHAR) AS evidencia_original "
        "FROM e_metricas WHERE codigo_error IS NOT NULL ORDER BY entidad, numero_fila",
    ),
    "error_distribution": (
        error_distribution,
        ctes(*_ALL) + f"SELECT codigo_error, COUNT(*) AS cantidad FROM ({_REJECTS}) r GROUP BY codigo_error",
    ),
    "quality_summary": (quality_summary, ctes(*_ALL) + _SUMMARY),
    "quality_gate": (
        quality_gate,
        ctes("usuarios", "datasets", "metricas")
        + "SELECT entidad, recibidas, 'CONTROLES_OK' AS resultado FROM ("
        + _union("SELECT '{e}' AS entidad, COUNT(*) AS recibidas FROM e_{e}", ["usuarios", "datasets", "metricas"])
        + ") t",
    ),
    "load_control": (
        load_control,
        ctes(*_ALL)
        + ", a AS (SELECT lote_id, COUNT(*) AS n FROM (" + _union("SELECT lote_id FROM s_{e}") + ") x GROUP BY lote_id), "
        + f"r AS (SELECT lote_id, COUNT(*) AS n FROM ({_REJECTS}) x GROUP BY lote_id) "
        "SELECT coalesce(a.lote_id, r.lote_id) AS lote_id, coalesce(a.n, 0) AS filas_aceptadas, coalesce(r.n, 0) AS filas_rechazadas, "
        "'COMPLETADO' AS estado FROM a FULL OUTER JOIN r ON a.lote_id = r.lote_id",
    ),
    "first_occurrence": (
        first_occurrence,
        ctes("metricas") + "SELECT id, lote_id, numero_fila FROM e_metricas WHERE id IS NOT NULL AND experimento_id IS NOT NULL AND nombre IS NOT NULL AND valor IS NOT NULL AND veces > 1",
    ),
    "gold_dim_fecha": (dim_fecha, ctes("experimentos", "metricas") + _DIM_FECHA),
    "gold_dim_usuario": (
        dim_usuario,
        ctes("usuarios") + "SELECT id AS usuario_key, id AS usuario_id_origen, nombre, email, activo, fecha_alta FROM s_usuarios",
    ),
    "gold_dim_dataset": (
        dim_dataset,
        ctes("datasets", "tipos_fuente")
        + "SELECT d.id AS dataset_key, d.id AS dataset_id_origen, d.usuario_id AS usuario_key, d.nombre, t.nombre AS tipo_fuente, "
        "d.fuente_detalle, d.cantidad_registros, d.fecha_creacion FROM s_datasets d JOIN s_tipos_fuente t ON t.id = d.tipo_fuente_id",
    ),
    "gold_dim_experimento": (
        dim_experimento,
        ctes("experimentos")
        + "SELECT id AS experimento_key, id AS experimento_id_origen, dataset_id AS dataset_key, nombre, descripcion, fecha, finalizado FROM s_experimentos",
    ),
    "gold_dim_metrica": (
        dim_metrica,
        ctes("metricas") + f"SELECT DISTINCT CAST({_METRIC_KEY} AS SMALLINT) AS metrica_key, nombre FROM s_metricas",
    ),
    "gold_dim_modelo": (
        dim_modelo,
        ctes("modelos", "tipos_modelo")
        + "SELECT m.id AS modelo_key, m.id AS modelo_id_origen, m.usuario_id AS usuario_key, m.nombre, t.nombre AS tipo_modelo, m.version, m.fecha_creacion "
        "FROM s_modelos m JOIN s_tipos_modelo t ON t.id = m.tipo_modelo_id",
    ),
    "gold_bridge": (
        bridge,
        ctes("experimentos_modelos")
        + "SELECT experimento_id AS experimento_key, modelo_id AS modelo_key, parametros, resultado, "
        "CAST(try_cast(parametros_jsonb AS JSON) ->> '$.linea' AS BIGINT) AS linea, try_cast(parametros_jsonb AS JSON) ->> '$.criterion' AS criterion, lote_id "
        "FROM s_experimentos_modelos",
    ),
    "gold_fact": (
        fact,
        ctes("metricas")
        + f"SELECT id AS metrica_experimento_key, id AS metrica_id_origen, {_DATE_KEY.format(d='fecha_registro')} AS fecha_key, experimento_id AS experimento_key, "
        f"CAST({_METRIC_KEY} AS SMALLINT) AS metrica_key, CAST(valor AS DOUBLE) AS valor, fecha_registro, lote_id, archivo_origen FROM s_metricas",
    ),
    "integrity_controls": (
        integrity_controls,
        ctes(*_ALL)
        + ", f AS (SELECT experimento_id AS x, nombre, fecha_registro FROM s_metricas UNION ALL "
        "SELECT -experimento_id, nombre, fecha_registro FROM s_metricas WHERE id % 50 = 0 UNION ALL "
        "SELECT experimento_id, nombre, fecha_registro FROM s_metricas WHERE id % 40 = 0), "
        "b AS (SELECT modelo_id AS m FROM s_experimentos_modelos UNION ALL "
        "SELECT -modelo_id FROM s_experimentos_modelos WHERE experimento_id % 3 = 0), "
        "per_grain AS (SELECT count(*) AS n FROM f GROUP BY x, nombre, fecha_registro) "
        "SELECT unnest(['duplicados_hecho', 'hechos_sin_experimento', 'puentes_sin_modelo']) AS control, unnest(["
        "(SELECT count(*) FROM per_grain WHERE n > 1), "
        "(SELECT count(*) FROM f WHERE x NOT IN (SELECT id FROM s_experimentos)), "
        "(SELECT count(*) FROM b WHERE m NOT IN (SELECT id FROM s_modelos))]) AS cantidad",
    ),
    "olap_mean_by_date": (
        olap_mean_by_date,
        ctes("experimentos", "metricas")
        + ", per_day AS (SELECT date_trunc('day', fecha_registro)::DATE AS fecha, nombre AS metrica, sum(valor)::DOUBLE AS total, "
        "count(valor) AS mediciones FROM s_metricas GROUP BY ALL) "
        "SELECT fecha, metrica, round((total / mediciones)::DECIMAL(28,10), 4)::DOUBLE AS promedio, mediciones FROM per_day",
    ),
    "olap_models_by_experiment": (
        olap_models_by_experiment,
        ctes("experimentos_modelos")
        + ", named AS (SELECT x.nombre AS experimento, list_sort(list(y.nombre)) AS modelos FROM s_experimentos_modelos r, s_experimentos x, s_modelos y "
        "WHERE r.experimento_id = x.id AND r.modelo_id = y.id GROUP BY x.nombre) "
        "SELECT experimento, len(modelos)::BIGINT AS modelos_participantes, array_to_string(modelos, ', ') AS modelos FROM named",
    ),
    "olap_accuracy_by_owner": (
        olap_accuracy_by_owner,
        ctes(*_ALL)
        + ", per_experiment AS (SELECT experimento_id AS id, sum(valor)::DOUBLE AS total, count(valor) AS n FROM s_metricas "
        "WHERE nombre = 'accuracy' GROUP BY experimento_id), "
        "per_dataset AS (SELECT dataset_id AS id, sum(total) AS total, sum(n) AS n FROM s_experimentos JOIN per_experiment USING (id) GROUP BY dataset_id) "
        "SELECT o.nombre AS propietario, t.nombre AS dataset, round((sum(p.total) / sum(p.n))::DECIMAL(28,10), 4)::DOUBLE AS accuracy_promedio "
        "FROM per_dataset p JOIN s_datasets t USING (id) JOIN s_usuarios o ON o.id = t.usuario_id GROUP BY o.nombre, t.nombre",
    ),
}

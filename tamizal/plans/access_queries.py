"""Queries over layouts, files and changes, with what they read as part of their result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.functions import cleaning, jsonb
from tamizal.operators import constraints, mutate
from tamizal.operators.introspect import work_done
from tamizal.operators.views import PartedSnapshot, create_view
from tamizal.plans import dirty, document_queries
from tamizal.plans.relational_queries import table
from tamizal.session import materialize, scratch_path
from tamizal.sources import layout
from tamizal.sources.records import INVALID, read_records


def _measured(spark, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "camino string, leidas bigint, devueltas bigint, intercambios bigint")


def _path(name: str, rows: DataFrame) -> tuple:
    """Rows a path reads and returns: only their number leaves the executors."""
    counted = rows.agg(F.count(F.lit(1)).alias("n"))
    done = work_done(counted)
    return name, done["rows"], counted.first()[0], done["exchanges"] - 1  # one is the count's own


def access_paths(spark, sf):
    """One event type before and after the events are laid out by type, by day, and with the type's rows in few files."""
    events = table(spark, sf, "events")
    by_type, by_day = scratch_path(spark, "by-type"), scratch_path(spark, "by-day")
    layout.write_partitioned(events, by_type, ["event_type"], ["user_id"])
    layout.write_time_series(events, by_day, "ts", ["event_type"])
    wanted = F.col("event_type") == "purchase"
    plain = table(spark, sf, "events").where(wanted)
    typed = spark.read.parquet(by_type).where(wanted)
    day = spark.read.parquet(by_day).where(F.col("fecha_dia") == F.lit("2024-01-10").cast("date"))
    return _measured(spark, [_path("tabla", plain), _path("carpeta de tipo", typed), _path("carpeta de dia", day)])


def bucketed_join(spark, sf):
    """Orders and their lines as tables bucketed by order: the join moves no row, and neither does a count per order."""
    mark = uuid.uuid4().hex[:12]
    names = f"tamizal_orders_{mark}", f"tamizal_lines_{mark}"
    try:
        layout.write_bucketed(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), names[0], ["o_orderkey"], 8)
        layout.write_bucketed(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity"), names[1], ["l_orderkey"], 8)
        orders, lines = (spark.table(n) for n in names)
        joined = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
        per_order = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).where("q > 100")
        return _measured(spark, [_path("union por cubo", joined), _path("grupo por cubo", per_order)])
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def element_side_table(spark, sf):
    """Orders of each part, found through the side table of an order document's elements."""
    lines = table(spark, sf, "lineitem")
    documents = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("lineas"))
    index = layout.element_index(documents, "l_orderkey", "lineas", "l_partkey")
    return index.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("pedidos"), F.min("l_orderkey").alias("primero"))


def hot_json_keys(spark, sf):
    """A key of the events' JSON as a column of its own, filtered and counted without parsing again."""
    path = scratch_path(spark, "hot-keys")
    events = table(spark, sf, "events").withColumn("v", F.parse_json("props"))
    layout.with_hot_keys(events, "v", {"k": "bigint"}).select("event_id", "event_type", "k").write.parquet(path)
    return spark.read.parquet(path).where("k >= 50").groupBy("event_type").agg(F.count(F.lit(1)).alias("cantidad"), F.sum("k").alias("suma"))


def update_counters(spark, sf):
    """Rows that an update matches, really changes, and looks at."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    changed, seen = mutate.counted_update(orders, F.col("o_orderpriority") == "1-URGENT", {"o_orderstatus": F.lit("F")})
    after = materialize(changed, "updated")
    got = seen.get
    return after.agg(F.count_if(F.col("o_orderstatus") == "F").alias("cerrados")).select(
        *[F.lit(got[n]).cast("bigint").alias(name) for n, name in (("matched", "coinciden"), ("modified", "modificadas"), ("scanned", "miradas"))], "cerrados"
    )


def json_large_numbers(spark, sf):
    """Containment tells integers apart that are one and the same double."""
    number = F.lit(9007199254740992).cast("decimal(20,0)") + F.col("o_orderkey") % 3
    rows = table(spark, sf, "orders").select("o_orderstatus", F.parse_json(F.concat(F.lit('{"n": '), number.cast("string"), F.lit("}"))).alias("v"))
    wanted = {9007199254740992: "par", 9007199254740993: "impar"}
    counts = [F.count_if(jsonb.contains("v", {"n": n})).alias(name) for n, name in wanted.items()]
    return rows.groupBy("o_orderstatus").agg(*counts)


def quoted_records(spark, sf):
    """Documents written as CSV whose quoted texts hold line breaks, some with a field too many or too few, and read back."""
    path = scratch_path(spark, "quoted")
    docs = table(spark, sf, "documents")

    def quoted(value) -> object:
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))

    fields = [F.col("doc_id").cast("string"), F.coalesce(quoted(F.col("text")), F.lit("")), F.coalesce("lang", F.lit(""))]
    more = F.when(F.col("doc_id") % 11 == 3, F.array(*fields, F.lit("sobra"))).when(F.col("doc_id") % 13 == 5, F.array(*fields[:2]))
    line = F.array_join(F.coalesce(more, F.array(*fields)), ",")
    placed = docs.select(line.alias("value"), F.col("doc_id").alias("doc_id_")).repartitionByRange("doc_id_").select("value")
    # a task writes one file, and its own first row brings the header: no second reading of the tasks has to agree
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    headed = placed.select(F.when(first, F.concat(F.lit("doc_id,text,lang\n"), "value")).otherwise(F.col("value")).alias("value"))
    headed.write.option("maxRecordsPerFile", 0).text(path)
    found = read_records(spark, f"{path}/*.txt", ["doc_id", "text", "lang"])
    kind = F.when(F.col(INVALID).isNull(), F.lit("entero")).otherwise(F.lit("con otros campos"))
    return found.groupBy(kind.alias("registro")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum(F.col("doc_id").cast("bigint")).alias("ids"),
        F.sum(F.when(F.col(INVALID).isNull(), F.length("text"))).cast("bigint").alias("letras"),
        F.sum(F.when(F.col(INVALID).isNull(), F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("bigint"))).alias("huellas"),
        F.count_distinct("archivo_origen", "numero_fila").alias("lugares"),
    )


def snapshot_by_parts(spark, sf):
    """A stored aggregate of the events that three batches have refreshed, one of them twice."""
    events = table(spark, sf, "events").select("event_type", "value", F.pmod("event_id", F.lit(3)).alias("lote"))
    stored = PartedSnapshot(spark, scratch_path(spark, "parts"), ["event_type"], "value")
    for batch in (0, 1, 1, 2):
        stored.refresh(str(batch), events.where(F.col("lote") == batch))
    return stored.read()


def composite_key_report(spark, sf):
    """Lines under one (order, number) more than once, and lines of parts or suppliers that are not there: one pass over the lines."""
    tables = {n: table(spark, sf, n) for n in ("lineitem", "part", "supplier")}
    rules = [
        constraints.Unique("lineitem", ("l_orderkey", "l_linenumber"), primary=True),
        constraints.ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
        constraints.ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        constraints.Unique("part", ("p_partkey",), primary=True),
        constraints.Check("lineitem", "descuento", "l_discount < 0.1", ("l_discount",)),
        constraints.NotNull("lineitem", "l_shipdate"),
    ]
    return constraints.violations(tables, rules).select("tabla", "restriccion", "tipo", "clave", "filas")


def clean_user_view(spark, sf):
    """The cleaning functions in SQL text, over a view of the raw users."""
    cleaning.register(spark)
    create_view(dirty.raw(spark, sf, "usuarios"), "vw_usuarios_crudos")
    return spark.sql(
        "SELECT lote_id, numero_fila, entero_seguro(id) AS id, texto_limpio(nombre) AS nombre, lower(texto_limpio(email)) AS email, "
        "booleano_seguro(activo) AS activo, fecha_hora_segura(fecha_alta) AS fecha_alta FROM vw_usuarios_crudos"
    )


def views_over_views(spark, sf):
    """A view that joins, a view over it that counts, and a question asked of the second in SQL."""
    customer, nation, orders = (table(spark, sf, n) for n in ("customer", "nation", "orders"))
    owned = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    create_view(owned.select("o_orderkey", "o_orderstatus", "c_mktsegment", "n_name"), "vw_pedidos_por_pais")
    counted = spark.table("vw_pedidos_por_pais").groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("pedidos"), F.count_if(F.col("o_orderstatus") == "O").alias("abiertos"))
    create_view(counted, "vw_resumen_por_pais")
    return spark.sql("SELECT n_name, sum(pedidos) AS pedidos, sum(abiertos) AS abiertos, max_by(c_mktsegment, struct(pedidos, c_mktsegment)) AS mayor FROM vw_resumen_por_pais GROUP BY n_name")


def column_changes(spark, sf):
    """A column added with a type, filled where a test holds, another renamed by projection and one dropped."""
    part = mutate.add_column(table(spark, sf, "part"), "clase", "string")
    part = mutate.update_where(part, F.col("p_size") >= 25, {"clase": F.lit("grande")})
    part = mutate.drop_column(part, "p_name").withColumnRenamed("p_retailprice", "precio")
    return part.select("p_partkey", "p_brand", "p_size", "precio", "clase")


QUERIES = {
    "composite_key_report": (
        composite_key_report,
        "SELECT 'lineitem' AS tabla, 'lineitem_pkey' AS restriccion, 'PRIMARY KEY' AS tipo, '{\"l_orderkey\":' || l_orderkey || ',\"l_linenumber\":' || l_linenumber || '}' AS clave, COUNT(*) AS filas "
        "FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1 "
        "UNION ALL SELECT 'lineitem', 'lineitem_l_partkey_fkey', 'FOREIGN KEY', '{\"l_partkey\":' || l_partkey || '}', COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY l_partkey "
        "UNION ALL SELECT 'lineitem', 'lineitem_l_suppkey_fkey', 'FOREIGN KEY', '{\"l_suppkey\":' || l_suppkey || '}', COUNT(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_suppkey "
        "UNION ALL SELECT 'part', 'part_pkey', 'PRIMARY KEY', '{\"p_partkey\":' || p_partkey || '}', COUNT(*) FROM part GROUP BY p_partkey HAVING COUNT(*) > 1 "
        "UNION ALL SELECT 'lineitem', 'lineitem_descuento_check', 'CHECK', '{\"l_discount\":' || l_discount || '}', COUNT(*) FROM lineitem WHERE NOT l_discount < 0.1 GROUP BY l_discount "
        "UNION ALL SELECT 'lineitem', 'lineitem_l_shipdate_not_null', 'NOT NULL', NULL, COUNT(*) FROM lineitem WHERE l_shipdate IS NULL HAVING COUNT(*) > 0",
    ),
    "clean_user_view": (clean_user_view, document_queries.QUERIES["clean_user_text"][1]),
    "views_over_views": (
        views_over_views,
        "WITH r AS (SELECT n_name, c_mktsegment, COUNT(*) AS pedidos, count_if(o_orderstatus = 'O') AS abiertos FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) "
        "SELECT n_name, SUM(pedidos)::BIGINT AS pedidos, SUM(abiertos)::BIGINT AS abiertos, arg_max(c_mktsegment, {'p': pedidos, 's': c_mktsegment}) AS mayor FROM r GROUP BY 1",
    ),
    "column_changes": (
        column_changes,
        "SELECT p_partkey, p_brand, p_size, p_retailprice AS precio, CASE WHEN p_size >= 25 THEN 'grande' END AS clase FROM part",
    ),
    "access_paths": (
        access_paths,
        "SELECT 'tabla' AS camino, COUNT(*) AS leidas, count_if(event_type = 'purchase')::BIGINT AS devueltas, 0::BIGINT AS intercambios FROM events "
        "UNION ALL SELECT 'carpeta de tipo', COUNT(*), COUNT(*), 0 FROM events WHERE event_type = 'purchase' "
        "UNION ALL SELECT 'carpeta de dia', COUNT(*), COUNT(*), 0 FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'",
    ),
    "bucketed_join": (
        bucketed_join,
        "SELECT 'union por cubo' AS camino, (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM lineitem) AS leidas, "
        "(SELECT COUNT(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey) AS devueltas, 0::BIGINT AS intercambios "
        "UNION ALL SELECT 'grupo por cubo', (SELECT COUNT(*) FROM lineitem), (SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING SUM(l_quantity) > 100)), 0",
    ),
    "element_side_table": (
        element_side_table,
        "SELECT l_partkey, COUNT(DISTINCT l_orderkey) AS pedidos, MIN(l_orderkey) AS primero FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1",
    ),
    "hot_json_keys": (
        hot_json_keys,
        "SELECT event_type, COUNT(*) AS cantidad, SUM(k)::BIGINT AS suma FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) WHERE k >= 50 GROUP BY 1",
    ),
    "update_counters": (
        update_counters,
        "SELECT count_if(o_orderpriority = '1-URGENT')::BIGINT AS coinciden, count_if(o_orderpriority = '1-URGENT' AND o_orderstatus IS DISTINCT FROM 'F')::BIGINT AS modificadas, "
        "COUNT(*) AS miradas, count_if(o_orderpriority = '1-URGENT' OR o_orderstatus = 'F')::BIGINT AS cerrados FROM orders",
    ),
    "json_large_numbers": (
        json_large_numbers,
        "SELECT o_orderstatus, count_if(o_orderkey % 3 = 0)::BIGINT AS par, count_if(o_orderkey % 3 = 1)::BIGINT AS impar FROM orders GROUP BY 1",
    ),
    "quoted_records": (
        quoted_records,
        "SELECT CASE WHEN bad THEN 'con otros campos' ELSE 'entero' END AS registro, COUNT(*) AS filas, SUM(doc_id)::BIGINT AS ids, "
        "SUM(CASE WHEN NOT bad THEN length(text) END)::BIGINT AS letras, SUM(CASE WHEN NOT bad THEN ('0x' || substring(md5(text), 1, 8))::BIGINT END)::BIGINT AS huellas, COUNT(*) AS lugares "
        "FROM (SELECT *, doc_id % 11 = 3 OR doc_id % 13 = 5 AS bad FROM documents) GROUP BY 1",
    ),
    "snapshot_by_parts": (
        snapshot_by_parts,
        "SELECT event_type, COUNT(*) AS filas, CAST(round(CAST(CAST(SUM(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / COUNT(value) AS DECIMAL(28,10)), 4) AS DOUBLE) AS promedio, "
        "MIN(value) AS minimo, MAX(value) AS maximo FROM events GROUP BY 1",
    ),
}

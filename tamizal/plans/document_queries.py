"""Nested documents, arrays, JSON text, row changes, constraints and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamizal.functions import arrays, jsonb
from tamizal.functions.cleaning import clean_text, safe_boolean, safe_decimal, safe_integer, safe_timestamp, strip_accents
from tamizal.operators import constraints as c
from tamizal.operators import mutate
from tamizal.operators.documents import document_violations
from tamizal.operators.nesting import dangling, elements_meet, first_element, lookup, lookup_unwind, nest, unwind, value_map
from tamizal.operators.profile import rows_per_source
from tamizal.operators.relational import exact_mean
from tamizal.operators.views import Snapshot
from tamizal.plans import dirty
from tamizal.plans.entities import ENTITIES
from tamizal.plans.relational_queries import TABLES, table
from tamizal.session import materialize, scratch_path
from tamizal.sources.bronze import read_csv, with_lineage
from tamizal.sources.layout import read_time_range, write_time_series

LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]


def order_documents(spark, sf):
    """One document per order: the embedded customer and the array of its lines."""
    lines = nest(table(spark, sf, "lineitem"), ["l_orderkey"], LINE, "lineas", LINE)
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    owner = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("_owner"),
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("nombre"),
            F.col("c_mktsegment").alias("segmento"),
            F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nombre")).alias("pais"),
        ).alias("cliente"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    # owners meet the short rows; the arrays then stay where they were built
    owned = orders.join(owner, F.col("o_custkey") == F.col("_owner"), "left")
    return owned.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("estado"), F.col("o_totalprice").alias("importe"), "cliente", "lineas"
    )


def line_documents(spark, sf, fields=LINE):
    """One document per order with the array of its lines, each with ``fields`` only."""
    return nest(table(spark, sf, "lineitem"), ["l_orderkey"], fields, "lineas", fields)


def nested_build(spark, sf):
    shown = F.transform("lineas", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string")))
    return order_documents(spark, sf).select(
        "id", F.col("cliente.nombre").alias("cliente"), F.col("cliente.pais.nombre").alias("pais"),
        F.size("lineas").cast("bigint").alias("n"), F.array_join(shown, ",").alias("lineas"),
    )


def nested_projection(spark, sf):
    """Filter and rename along struct paths."""
    documents = order_documents(spark, sf)
    return documents.where(F.col("cliente.segmento") == "BUILDING").select(
        F.col("id").alias("pedido"), F.col("cliente.nombre").alias("cliente"), F.col("cliente.pais.id").alias("pais"), "importe"
    )


def path_through_array(spark, sf):
    """A path through an array of structs gives the array of that field."""
    parts = F.transform(F.col("lineas.l_partkey"), lambda x: x.cast("string"))
    documents = line_documents(spark, sf, ["l_linenumber", "l_partkey"])
    return documents.select("l_orderkey", F.array_join(parts, ",").alias("partes"))


def unwind_lines(spark, sf):
    flat = unwind(line_documents(spark, sf), "lineas", "x")
    return flat.select("l_orderkey", *[F.col(f"x.{f}").alias(f) for f in LINE])


def any_elem(spark, sf):
    """Some line returned and some line, maybe another, of quantity 50."""
    lines = table(spark, sf, "lineitem")
    return elements_meet(lines, ["l_orderkey"], F.col("l_returnflag") == "R", F.col("l_quantity") == 50)


def elem_match(spark, sf):
    """One and the same line returned and of quantity 50."""
    lines = table(spark, sf, "lineitem")
    return elements_meet(lines, ["l_orderkey"], (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50))


def elem_project(spark, sf):
    """First returned line of each document that has one."""
    shown = ["l_linenumber", "l_partkey", "l_quantity"]
    return first_element(table(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", LINE, shown)


def lookup_array(spark, sf):
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    found = lookup(nation, supplier, "n_nationkey", "s_nationkey", "proveedores", ["s_name"], ["s_name", "s_suppkey"])
    names = F.array_join(F.col("proveedores.s_name"), ",")
    return found.select("n_nationkey", F.size("proveedores").cast("bigint").alias("n"), names.alias("proveedores"))


def lookup_unwind_pair(spark, sf):
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    return lookup_unwind(nation, supplier, F.col("n_nationkey") == F.col("s_nationkey")).select("n_name", "s_name")


def dangling_references(spark, sf):
    """Lines whose part is not among the parts below size 10, counted."""
    documents = line_documents(spark, sf)
    small = table(spark, sf, "part").where("p_size < 10")
    return dangling(documents, "lineas", "l_partkey", small, "p_partkey").agg(F.count(F.lit(1)).alias("cantidad"))


def empty_array(spark, sf):
    """Nations whose lookup of rich suppliers comes back empty."""
    rich = table(spark, sf, "supplier").where("s_acctbal > 5000")
    found = lookup(table(spark, sf, "nation"), rich, "n_nationkey", "s_nationkey", "ricos", ["s_suppkey"], ["s_suppkey"])
    return found.where(arrays.is_empty("ricos")).select("n_nationkey", "n_name")


def ordered_string_agg(spark, sf):
    """Distinct parts of an order, in order, as one text."""
    bridge = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    nested = nest(bridge, ["l_orderkey"], ["l_partkey"], "p", ["l_partkey"])
    text = F.array_join(F.transform("p", lambda x: x["l_partkey"].cast("string")), ", ")
    return nested.select("l_orderkey", F.size("p").cast("bigint").alias("n"), text.alias("partes"))


def _measures(spark, sf):
    return value_map(table(spark, sf, "events"), ["user_id"], "event_type", "value", "metricas", "event_id")


def field_presence(spark, sf):
    """Users whose map of measures has a purchase, with its value and the number of measures."""
    rows = _measures(spark, sf).where(F.map_contains_key("metricas", "purchase"))
    return rows.select("user_id", F.col("metricas")["purchase"].alias("purchase"), F.size("metricas").cast("bigint").alias("n"))


def group_by_map_value(spark, sf):
    """Documents with a click measure grouped by customer segment; absent measures are skipped."""
    rows = _measures(spark, sf).where(F.map_contains_key("metricas", "click"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = rows.withColumn("click", F.col("metricas")["click"]).join(customer, F.col("user_id") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("documentos"), exact_mean("click").alias("promedio"))


def map_difference(spark, sf):
    """Difference of two measures for the users that have both."""
    rows = _measures(spark, sf).where(F.map_contains_key("metricas", "click") & F.map_contains_key("metricas", "view"))
    click, view = F.col("metricas")["click"], F.col("metricas")["view"]
    return rows.select("user_id", (click - view).alias("diferencia")).orderBy(F.desc("diferencia"), "user_id")


# ---------------------------------------------------------------------------------- JSON


def json_text(spark, sf):
    return table(spark, sf, "events").select("event_id", jsonb.field_text("props", "k").alias("k"))


def json_has_key(spark, sf):
    rows = table(spark, sf, "events").withColumn("j", F.when(F.col("event_id") % 3 == 0, F.lit('{"z": null}')).otherwise(F.col("props")))
    return rows.select("event_id", jsonb.has_key("j", "k").alias("tiene_k"), jsonb.has_key("j", "z").alias("tiene_z"))


def json_contains(spark, sf):
    rows = table(spark, sf, "events").where(jsonb.contains(jsonb.parse("props"), {"k": 7}))
    return rows.select("event_id", "props")


def _order_json():
    return jsonb.struct_text(
        F.col("o_orderstatus").alias("estado"),
        F.struct((F.col("o_totalprice") > 250000).alias("alto"), F.substring("o_orderpriority", 1, 1).cast("int").alias("nivel")).alias("precio"),
        F.array("o_orderpriority", F.lit("web")).alias("etiquetas"),
    )


def json_nested_contains(spark, sf):
    orders = table(spark, sf, "orders").withColumn("doc", jsonb.parse(_order_json()))
    wanted = {"estado": "F", "precio": {"alto": True, "nivel": 2}, "etiquetas": ["web", "2-HIGH"]}
    return orders.where(jsonb.contains("doc", wanted)).select("o_orderkey")


def json_nested_path(spark, sf):
    orders = table(spark, sf, "orders").withColumn("doc", jsonb.parse(_order_json()))
    level = jsonb.field("doc", "precio", "nivel", kind="int")
    return orders.where(level == 1).select("o_orderkey", level.cast("bigint").alias("nivel"), jsonb.field("doc", "estado").alias("estado"))


def struct_to_json(spark, sf):
    customer = table(spark, sf, "customer")
    text = jsonb.struct_text(F.col("c_custkey").alias("id"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segmento"))
    return customer.select("c_custkey", text.alias("evidencia"))


def set_json_by_key(spark, sf):
    """A JSON column set on the keys of a change list, then one of its fields read."""
    part = table(spark, sf, "part")
    changes = part.where("p_size % 10 = 0").select("p_partkey", F.format_string('{"max_depth": %d, "criterion": "gini"}', "p_size").alias("parametros"))
    changed = mutate.set_by_key(part.select("p_partkey", "p_name"), changes, ["p_partkey"], "parametros")
    return changed.select("p_partkey", jsonb.field_text("parametros", "criterion").alias("criterion"), jsonb.field_text("parametros", "max_depth").alias("max_depth"))


# --------------------------------------------------------------------------- row changes


def array_add_remove(spark, sf):
    """Tags per customer: add once, add again, append a note, pull notes by author."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.array("c_mktsegment").alias("etiquetas"))
    tagged = mutate.add_to_set(customer, "etiquetas", F.lit("revisado"))
    tagged = mutate.add_to_set(tagged, "etiquetas", F.lit("BUILDING"))
    for author, test in (("ana", F.col("c_custkey") % 2 == 0), ("luis", F.col("c_custkey") % 3 == 0)):
        note = F.struct(F.lit(author).alias("autor"), F.lit("visto").alias("texto"))
        tagged = mutate.push(tagged, "notas", note, test)
    pulled = mutate.pull(tagged, "notas", lambda x: x["autor"] == "ana")
    authors = F.array_join(F.coalesce(F.transform("notas", lambda x: x["autor"]), F.array(F.lit("-"))), ",")
    return pulled.select("c_custkey", F.array_join("etiquetas", ",").alias("etiquetas"), authors.alias("autores"))


def update_when(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    changed = mutate.update_where(orders, F.col("o_orderpriority") == "5-LOW", {"o_orderstatus": F.lit("X")})
    return mutate.update_where(changed, None, {"o_orderpriority": F.substring("o_orderpriority", 3, 20)})


def delete_where(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("estado"))
    return mutate.delete_where(orders, F.col("estado") == "F")


def insert_rows(spark, sf):
    """Nations plus one new nation per region, ids after the highest."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    new = region.select(F.concat(F.lit("NUEVA_"), "r_name").alias("n_name"), F.col("r_regionkey").alias("n_regionkey"))
    numbered = mutate.assign_ids(new.withColumn("n_nationkey", F.lit(None).cast("int")), nation, ["n_name"], "n_nationkey")
    return mutate.insert_rows(nation, numbered.select(*nation.columns), ["n_nationkey"])


def seed_if_absent(spark, sf):
    """Purchases seed one row for every user that has no measure above 300."""
    events = table(spark, sf, "events")
    kept = events.where("value > 300").select("user_id", "event_type")
    candidates = events.where("event_type = 'purchase'").select("user_id", F.lit("semilla").alias("event_type")).distinct()
    return mutate.seed_if_absent(kept, candidates, ["user_id"])


# Order priorities and the category each belongs to; one is left unmapped.
PRIORITY_CATEGORIES = {"1-URGENT": "alta", "2-HIGH": "alta", "3-MEDIUM": "media", "5-LOW": "baja"}


def _category_catalog(spark, sf):
    """Catalog of the categories in use, from the orders themselves."""
    pairs = [F.lit(x) for item in PRIORITY_CATEGORIES.items() for x in item]
    used = table(spark, sf, "orders").select(F.try_element_at(F.create_map(*pairs), "o_orderpriority").alias("c"))
    return materialize(mutate.catalog_from(used, "c"), "categories")


def classify_text(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return mutate.normalize_column(orders, "o_orderpriority", PRIORITY_CATEGORIES, _category_catalog(spark, sf), "categoria_id", "detalle")


def unclassified_text(spark, sf):
    return mutate.unclassified(classify_text(spark, sf), "categoria_id").groupBy("detalle").agg(F.count(F.lit(1)).alias("cantidad"))


def catalog_ids(spark, sf):
    return mutate.catalog_from(table(spark, sf, "part"), "p_name")


def resolve_natural_key(spark, sf):
    """Customer ids found again from customer names."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    return mutate.resolve_key(orders, customer, "c_name", "c_name", "c_custkey", "cliente_id")


# -------------------------------------------------------------------- constraints, shapes


def constraint_report(spark, sf):
    """Violations of a copy with planted defects: repeats, orphans, nulls, values out of range."""
    customer = table(spark, sf, "customer")
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 97 == 5, F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("id"),
        F.when(F.col("o_orderkey") % 89 == 3, F.lit(-1)).otherwise(F.col("o_custkey")).alias("cliente_id"),
        F.when(F.col("o_orderkey") % 83 == 2, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("estado"),
        F.when(F.col("o_orderkey") % 79 == 1, -F.col("o_orderkey")).otherwise(F.lit(1)).cast("bigint").alias("cantidad"),
    )
    rules = [
        c.Unique("pedidos", ("id",), primary=True),
        c.ForeignKey("pedidos", "cliente_id", "clientes", "c_custkey"),
        c.NotNull("pedidos", "estado"),
        c.Check("pedidos", "cantidad", "cantidad >= 0", ("cantidad",)),
    ]
    return c.violations({"pedidos": orders, "clientes": customer}, rules)


def restricted_delete(spark, sf):
    """Customers of one segment cannot go while large orders refer to them."""
    doomed = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'")
    large = table(spark, sf, "orders").where("o_totalprice > 400000")
    return c.blocked_deletes(doomed, "c_custkey", {"orders": (large, "o_custkey")})


DOCUMENT_SCHEMA = {
    "bsonType": "object",
    "required": ["id", "lang", "cuerpo", "etiquetas"],
    "properties": {
        "id": {"bsonType": "int"},
        "lang": {"bsonType": "string", "minLength": 1},
        "cuerpo": {"bsonType": "object", "required": ["texto"], "properties": {"texto": {"bsonType": "string"}}},
        "etiquetas": {"bsonType": "array", "minItems": 1},
    },
}


def document_validator(spark, sf):
    """Documents as JSON text with planted defects; one row per document and broken rule."""
    key = F.col("doc_id")
    fields = F.struct(
        F.when(key % 11 != 1, key).alias("id"),
        F.when(key % 13 == 2, F.lit("")).otherwise(F.col("lang")).alias("lang"),
        F.when(key % 17 != 3, F.struct(F.when(key % 19 != 4, F.col("text")).alias("texto"))).alias("cuerpo"),
        F.when(key % 23 == 5, F.array_remove(F.array(F.lit("x")), "x")).otherwise(F.array("source")).alias("etiquetas"),
    )
    text = F.when(key % 29 == 6, F.lit("{cortado")).otherwise(F.to_json(fields))
    return document_violations(table(spark, sf, "documents").withColumn("json", text), "json", DOCUMENT_SCHEMA, ["doc_id"])


# ------------------------------------------------------------- snapshots, layouts, files


def snapshot_refresh(spark, sf):
    """A stored mean is stale after new rows arrive, and right again after a refresh."""
    events = table(spark, sf, "events")
    arrived = {"rows": events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))}

    def query():
        return arrived["rows"].groupBy("event_type").agg(exact_mean("value").alias("promedio"), F.count(F.lit(1)).alias("cantidad"))

    stored = Snapshot(spark, scratch_path(spark, "snapshot"), query)
    stored.refresh()
    arrived["rows"] = events
    stale = stored.read().withColumn("estado", F.lit("antes"))
    stored.refresh()
    return stale.unionByName(stored.read().withColumn("estado", F.lit("despues")))


def time_series_range(spark, sf):
    """Series written in day folders, one type over [start, end) read back."""
    path = scratch_path(spark, "series")
    series = table(spark, sf, "events").select(
        "ts", F.struct("user_id", "event_type").alias("meta"), "value", "event_id", F.col("event_type").alias("tipo")
    )
    write_time_series(series, path, "ts", ["tipo", "event_id"])
    found = read_time_range(spark, path, "ts", "2024-01-10T12:00:00", "2024-01-12T06:00:00")
    return found.where(F.col("meta.event_type") == "click").select("event_id", "ts", "value").orderBy("ts", "event_id")


def csv_lineage(spark, sf):
    """Dirty text written as CSV batches and read back with lineage: rows, gaps and repeats of line numbers."""
    root = scratch_path(spark, "incoming")
    raw = dirty.raw(spark, sf, "metricas")
    columns = list(ENTITIES["metricas"].columns)
    raw.select(*columns, F.col("lote_id").alias("lote")).write.partitionBy("lote").option("header", True).option("escape", '"').csv(root)
    rows = with_lineage(read_csv(spark, f"{root}/lote=*/*.csv", "metricas"), F.current_timestamp())
    per_file = rows.groupBy("lote_id", "archivo_origen").agg(
        F.count(F.lit(1)).alias("filas"),
        F.max("numero_fila").alias("ultima"),
        F.min("numero_fila").alias("primera"),
        F.count_distinct("numero_fila").alias("numeros"),
    )
    return per_file.groupBy("lote_id").agg(
        F.sum("filas").alias("filas"),
        F.sum(F.col("ultima") - 1 - F.col("numeros")).alias("huecos"),
        F.sum(F.col("filas") - F.col("numeros")).alias("repetidos"),
        F.min("primera").alias("primera"),
    )


def batch_profile(spark, sf):
    """Rows received per entity, batch and file."""
    return rows_per_source({e: dirty.raw(spark, sf, e) for e in ENTITIES})


def clean_user_text(spark, sf):
    raw = dirty.raw(spark, sf, "usuarios")
    return raw.select(
        "lote_id", "numero_fila", safe_integer("id").alias("id"), clean_text("nombre").alias("nombre"),
        F.lower(clean_text("email")).alias("email"), safe_boolean("activo").alias("activo"), safe_timestamp("fecha_alta").alias("fecha_alta"),
    )


def clean_metric_text(spark, sf):
    raw = dirty.raw(spark, sf, "metricas")
    return raw.select(
        "lote_id", "numero_fila", strip_accents(F.lower(clean_text("nombre"))).alias("nombre"),
        safe_decimal("valor").cast("double").alias("valor"), safe_timestamp("fecha_registro").alias("fecha_registro"),
    )


def schema_inventory(spark, sf):
    """Columns by table and position, with the rows and the filled values each column has."""
    out = None
    for name in TABLES:
        df = table(spark, sf, name)
        measured = df.agg(F.array(*[
            F.struct(F.lit(name).alias("tabla"), F.lit(i).cast("bigint").alias("posicion"), F.lit(f.name).alias("columna"), F.count(f.name).alias("no_nulas"))
            for i, f in enumerate(df.schema, start=1)
        ]).alias("m")).select(F.inline("m"))
        out = measured if out is None else out.unionByName(measured)
    return out


_ORDERED = "ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus"
_DOC = f"(SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' {_ORDERED}) AS lineas, COUNT(*) AS n FROM lineitem GROUP BY 1) d"
_MEAS = "(SELECT user_id, event_type, arg_max(value, event_id) AS v FROM events GROUP BY 1, 2)"
_MEAN = "CAST(SUM(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) / COUNT({c})"
_CLASS = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 WHEN o_orderpriority = '5-LOW' THEN 2 WHEN o_orderpriority = '3-MEDIUM' THEN 3 END"


def _clean_sql(entity: str, columns: str) -> str:
    return f"SELECT lote_id, numero_fila, {columns} FROM ({dirty.raw_sql(entity)}) r"


def _queries():
    from tamizal.plans.quality_queries import _bool, _dec, _int, _text, _ts

    schemas = {
        "region": "r_regionkey r_name",
        "nation": "n_nationkey n_name n_regionkey",
        "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
        "supplier": "s_suppkey s_name s_nationkey s_acctbal",
        "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
        "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
        "events": "event_id ts user_id event_type value props",
        "documents": "doc_id text lang source n_chars",
        "embeddings": "vec_id embedding label",
        "pages": "page_id url html",
        "benchmark": "item_id text",
        "labels": "doc_id quality toxic",
        "conversations": "conv_id turn role text",
    }
    return {
        "nested_build": (
            nested_build,
            f"SELECT o_orderkey AS id, c_name AS cliente, n_name AS pais, d.n, d.lineas FROM orders JOIN {_DOC} ON d.l_orderkey = o_orderkey "
            "LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey",
        ),
        "nested_projection": (
            nested_projection,
            f"SELECT o_orderkey AS pedido, c_name AS cliente, c_nationkey AS pais, o_totalprice AS importe FROM orders JOIN {_DOC} ON d.l_orderkey = o_orderkey "
            "JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'",
        ),
        "path_through_array": (path_through_array, f"SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' {_ORDERED}) AS partes FROM lineitem GROUP BY 1"),
        "unwind_lines": (unwind_lines, f"SELECT l_orderkey, {', '.join(LINE)} FROM lineitem"),
        "any_elem": (
            any_elem,
            "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)",
        ),
        "elem_match": (elem_match, "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50"),
        "elem_project": (
            elem_project,
            f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey {_ORDERED}) AS rn FROM lineitem WHERE l_returnflag = 'R') x WHERE rn = 1",
        ),
        "lookup_array": (
            lookup_array,
            "SELECT n_nationkey, COUNT(s_name) AS n, coalesce(string_agg(s_name, ',' ORDER BY s_name), '') AS proveedores FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1",
        ),
        "lookup_unwind": (lookup_unwind_pair, "SELECT n_name, s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey"),
        "dangling_references": (
            dangling_references,
            "SELECT COUNT(*) AS cantidad FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size < 10) p ON p_partkey = l_partkey WHERE p_partkey IS NULL",
        ),
        "empty_array": (
            empty_array,
            "SELECT n_nationkey, n_name FROM nation WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000)",
        ),
        "ordered_string_agg": (
            ordered_string_agg,
            "SELECT l_orderkey, COUNT(*) AS n, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_partkey) AS partes FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b GROUP BY 1",
        ),
        "field_presence": (
            field_presence,
            f"SELECT user_id, MAX(v) FILTER (event_type = 'purchase') AS purchase, COUNT(*) AS n FROM {_MEAS} m GROUP BY 1 HAVING count_if(event_type = 'purchase') > 0",
        ),
        "group_by_map_value": (
            group_by_map_value,
            f"SELECT c_mktsegment, COUNT(*) AS documentos, {_MEAN.format(c='v')} AS promedio FROM {_MEAS} m JOIN customer ON c_custkey = user_id WHERE event_type = 'click' GROUP BY 1",
        ),
        "map_difference": (
            map_difference,
            f"SELECT a.user_id, a.v - b.v AS diferencia FROM {_MEAS} a JOIN {_MEAS} b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'view' ORDER BY 2 DESC, 1",
        ),
        "json_text": (json_text, "SELECT event_id, CAST(props AS JSON) ->> '$.k' AS k FROM events"),
        "json_has_key": (
            json_has_key,
            "SELECT event_id, json_exists(j, '$.k') AS tiene_k, json_exists(j, '$.z') AS tiene_z FROM (SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN '{\"z\": null}' ELSE props END AS JSON) AS j FROM events) e",
        ),
        "json_contains": (json_contains, "SELECT event_id, props FROM events WHERE json_contains(CAST(props AS JSON), CAST('{\"k\": 7}' AS JSON))"),
        "json_nested_contains": (
            json_nested_contains,
            "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000 AND o_orderpriority = '2-HIGH'",
        ),
        "json_nested_path": (
            json_nested_path,
            "SELECT o_orderkey, CAST(1 AS BIGINT) AS nivel, o_orderstatus AS estado FROM orders WHERE o_orderpriority = '1-URGENT'",
        ),
        "struct_to_json": (
            struct_to_json,
            "SELECT c_custkey, CAST(to_json(struct_pack(id := c_custkey, segmento := nullif(c_mktsegment, 'BUILDING'))) AS VARCHAR) AS evidencia FROM customer",
        ),
        "set_json_by_key": (
            set_json_by_key,
            "SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'gini' END AS criterion, CASE WHEN p_size % 10 = 0 THEN CAST(p_size AS VARCHAR) END AS max_depth FROM part",
        ),
        "array_add_remove": (
            array_add_remove,
            "SELECT c_custkey, c_mktsegment || ',revisado' || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',BUILDING' END AS etiquetas, "
            "CASE WHEN c_custkey % 3 = 0 THEN 'luis' WHEN c_custkey % 2 = 0 THEN '' ELSE '-' END AS autores FROM customer",
        ),
        "update_when": (
            update_when,
            "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, substr(o_orderpriority, 3) AS o_orderpriority FROM orders",
        ),
        "delete_where": (delete_where, "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS estado FROM orders WHERE o_orderstatus <> 'F'"),
        "insert_rows": (
            insert_rows,
            "SELECT * FROM nation UNION ALL SELECT CAST((SELECT MAX(n_nationkey) FROM nation) + row_number() OVER (ORDER BY r_name) AS INTEGER), 'NUEVA_' || r_name, r_regionkey FROM region",
        ),
        "seed_if_absent": (
            seed_if_absent,
            "SELECT user_id, event_type FROM events WHERE value > 300 UNION ALL SELECT DISTINCT user_id, 'semilla' FROM events WHERE event_type = 'purchase' AND user_id NOT IN (SELECT user_id FROM events WHERE value > 300)",
        ),
        "classify_text": (classify_text, f"SELECT o_orderkey, o_orderpriority AS detalle, CAST({_CLASS} AS BIGINT) AS categoria_id FROM orders"),
        "unclassified_text": (unclassified_text, f"SELECT o_orderpriority AS detalle, COUNT(*) AS cantidad FROM orders WHERE ({_CLASS}) IS NULL GROUP BY 1"),
        "catalog_ids": (catalog_ids, "SELECT row_number() OVER (ORDER BY nombre) AS id, nombre FROM (SELECT DISTINCT p_name AS nombre FROM part) p"),
        "resolve_natural_key": (resolve_natural_key, "SELECT o_orderkey, o_custkey AS cliente_id FROM orders"),
        "constraint_report": (
            constraint_report,
            "WITH p AS (SELECT CASE WHEN o_orderkey % 97 = 5 THEN o_orderkey - 1 ELSE o_orderkey END AS id, CASE WHEN o_orderkey % 89 = 3 THEN -1 ELSE o_custkey END AS cliente_id, "
            "CASE WHEN o_orderkey % 83 = 2 THEN NULL ELSE o_orderstatus END AS estado, CASE WHEN o_orderkey % 79 = 1 THEN -o_orderkey ELSE 1 END AS cantidad FROM orders) "
            "SELECT 'pedidos' AS tabla, 'pedidos_pkey' AS restriccion, 'PRIMARY KEY' AS tipo, '{\"id\":' || id || '}' AS clave, COUNT(*) AS filas FROM p GROUP BY id HAVING COUNT(*) > 1 "
            "UNION ALL SELECT 'pedidos', 'pedidos_cliente_id_fkey', 'FOREIGN KEY', '{\"cliente_id\":' || cliente_id || '}', COUNT(*) FROM p WHERE cliente_id NOT IN (SELECT c_custkey FROM customer) GROUP BY cliente_id "
            "UNION ALL SELECT 'pedidos', 'pedidos_estado_not_null', 'NOT NULL', NULL, COUNT(*) FROM p WHERE estado IS NULL "
            "UNION ALL SELECT 'pedidos', 'pedidos_cantidad_check', 'CHECK', '{\"cantidad\":' || cantidad || '}', COUNT(*) FROM p WHERE cantidad < 0 GROUP BY cantidad",
        ),
        "restricted_delete": (
            restricted_delete,
            "SELECT 'orders' AS tabla, o_custkey AS clave, COUNT(*) AS filas FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY' AND o_totalprice > 400000 GROUP BY 2",
        ),
        "document_validator": (
            document_validator,
            "WITH d AS (SELECT *, doc_id % 29 = 6 AS roto FROM documents) "
            "SELECT doc_id, '$:json' AS regla FROM d WHERE roto UNION ALL SELECT doc_id, '$.id:required' FROM d WHERE NOT roto AND doc_id % 11 = 1 "
            "UNION ALL SELECT doc_id, '$.lang:minLength' FROM d WHERE NOT roto AND doc_id % 13 = 2 UNION ALL SELECT doc_id, '$.cuerpo:required' FROM d WHERE NOT roto AND doc_id % 17 = 3 "
            "UNION ALL SELECT doc_id, '$.cuerpo.texto:required' FROM d WHERE NOT roto AND doc_id % 17 <> 3 AND doc_id % 19 = 4 "
            "UNION ALL SELECT doc_id, '$.etiquetas:minItems' FROM d WHERE NOT roto AND doc_id % 23 = 5",
        ),
        "snapshot_refresh": (
            snapshot_refresh,
            f"SELECT event_type, {_MEAN.format(c='value')} AS promedio, COUNT(*) AS cantidad, 'antes' AS estado FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1 "
            f"UNION ALL SELECT event_type, {_MEAN.format(c='value')}, COUNT(*), 'despues' FROM events GROUP BY 1",
        ),
        "time_series_range": (
            time_series_range,
            "SELECT event_id, ts, value FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-12 06:00:00' ORDER BY ts, event_id",
        ),
        "csv_lineage": (
            csv_lineage,
            f"SELECT lote_id, COUNT(*) AS filas, CAST(0 AS BIGINT) AS huecos, CAST(0 AS BIGINT) AS repetidos, CAST(2 AS BIGINT) AS primera FROM ({dirty.raw_sql('metricas')}) r GROUP BY 1",
        ),
        "batch_profile": (
            batch_profile,
            " UNION ALL ".join(
                f"SELECT '{e}' AS entidad, lote_id, archivo_origen, COUNT(*) AS filas FROM ({dirty.raw_sql(e)}) r GROUP BY 2, 3" for e in ENTITIES
            ),
        ),
        "clean_user_text": (
            clean_user_text,
            _clean_sql(
                "usuarios",
                f"{_int('id')} AS id, {_text('nombre')} AS nombre, lower({_text('email')}) AS email, {_bool('activo')} AS activo, {_ts('fecha_alta')} AS fecha_alta",
            ),
        ),
        "clean_metric_text": (
            clean_metric_text,
            _clean_sql("metricas", f"strip_accents(lower({_text('nombre')})) AS nombre, CAST({_dec('valor')} AS DOUBLE) AS valor, {_ts('fecha_registro')} AS fecha_registro"),
        ),
        "schema_inventory": (
            schema_inventory,
            " UNION ALL ".join(
                f"SELECT '{t}' AS tabla, CAST({i} AS BIGINT) AS posicion, '{col}' AS columna, COUNT({col}) AS no_nulas FROM {t}"
                for t, names in schemas.items()
                for i, col in enumerate(names.split(), start=1)
            ),
        ),
    }


QUERIES = _queries()

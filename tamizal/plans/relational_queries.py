"""Projections, filters, joins, aggregates, windows, sorts and unions over the analytic tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.functions.calendar import calendar_columns
from tamizal.operators.profile import column_profile
from tamizal.operators.ranking import add_rank, add_row_number, top_k, with_group_value
from tamizal.operators.relational import count_children, exact_mean, quotient, repeated_at, rounded, rounded_mean, visible, with_match, without_match
from tamizal.session import materialize

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------- projections and filters


def project_filter(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)).select(
        F.col("o_orderkey").alias("pedido"), F.col("o_custkey").alias("cliente"), F.col("o_totalprice").alias("importe")
    )


def all_but_some_columns(spark, sf):
    return table(spark, sf, "supplier").drop("s_acctbal")


def label_and_computed(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.lit("lineitem").alias("entidad"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
        .cast("double")
        .alias("neto"),
    )


def in_list_null_like(spark, sf):
    part = table(spark, sf, "part")
    return part.where(
        F.col("p_type").isin("ECONOMY", "PROMO") & F.col("p_brand").like("Brand#1%") & F.col("p_name").isNotNull()
    ).select("p_partkey", "p_brand", "p_type")


def not_in_or(spark, sf):
    part = table(spark, sf, "part")
    return part.where(~F.col("p_type").isin("ECONOMY", "PROMO") | (F.col("p_size") >= 45)).select("p_partkey", "p_type", "p_size")


def half_open_range(spark, sf):
    return (
        table(spark, sf, "events")
        .where(
            (F.col("event_type") == "purchase")
            & (F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
            & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
        )
        .select("event_id", "ts", "user_id", "value")
        .orderBy("ts", "event_id")
    )


def above_global_avg(spark, sf):
    events = table(spark, sf, "events")
    mean = events.select(exact_mean("value")).scalar()
    return events.where(F.col("value") > mean).select("event_id", "event_type", "value")


def point_lookup(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderkey") == 77).limit(1)


def visible_text(spark, sf):
    part = table(spark, sf, "part").withColumn("tipo", F.nullif(F.col("p_type"), F.lit("PROMO")))
    return part.select("p_partkey", visible("p_name").alias("nombre_visible"), visible("tipo", "NULL").alias("tipo_visible"))


# --------------------------------------------------------------------------------- joins


def inner_two(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey", "o_orderpriority", "l_partkey", "l_linenumber", "l_quantity"
    )


def path_join(spark, sf):
    """Catalogs, customers and orders are joined first, so the long table crosses the network once
    per key it is joined on and not once per table of the path."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    orders, lines, part = (table(spark, sf, t) for t in ("orders", "lineitem", "part"))
    owners = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    owned = orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name", "n_name", "c_name")
    return (
        lines.join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select("r_name", "n_name", "c_name", "o_orderkey", "p_name", "p_type", "l_linenumber", "l_quantity")
    )


def compound_on(spark, sf):
    """A constant condition in ``ON`` reaches the scan of the joined side."""
    events, customer, nation, region = (table(spark, sf, t) for t in ("events", "customer", "nation", "region"))
    per_user = events.groupBy("user_id").agg(F.sum(F.col("value").cast("decimal(28,6)")).alias("total"), F.count("value").alias("n"))
    buyers = per_user.join(customer, (F.col("user_id") == F.col("c_custkey")) & (F.col("c_mktsegment") == "BUILDING"))
    return (
        buyers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name")
        .agg(F.sum("total").alias("t"), F.sum("n").alias("mediciones"))
        .select("r_name", "n_name", quotient(F.col("t"), F.col("mediciones")).alias("promedio"), "mediciones")
    )


def _large_orders(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_totalprice") > 450000)


def semi_join(spark, sf):
    customer, large = table(spark, sf, "customer"), _large_orders(spark, sf)
    return with_match(customer, large, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name")


def anti_join_owner(spark, sf):
    customer, large = table(spark, sf, "customer"), _large_orders(spark, sf)
    return without_match(customer, large, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name")


def anti_join_child(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return without_match(orders, lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey")


def left_zero_counts(spark, sf):
    """Lines of every order, zero where it has none."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    counted = count_children(orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", "lineas")
    return counted.orderBy(F.desc("lineas"), "o_orderkey")


def inner_then_left(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    owned = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    counted = count_children(owned, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", "lineas")
    return counted.select("c_name", "o_orderkey", "lineas")


def full_outer_counts(spark, sf):
    """Returned against accepted lines per order, an order missing on one side counts zero there."""
    lines = table(spark, sf, "lineitem")
    back = lines.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("a"))
    kept = lines.where("l_returnflag = 'N'").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("b"))
    return back.join(kept, "l_orderkey", "full_outer").select(
        "l_orderkey", F.coalesce("a", F.lit(0)).cast("bigint").alias("devueltas"), F.coalesce("b", F.lit(0)).cast("bigint").alias("aceptadas")
    )


def surrogate_update(spark, sf):
    """Text replaced by the key of its catalog; catalog keys follow the text order."""
    part = table(spark, sf, "part")
    kinds = add_row_number(materialize(part.select("p_type").distinct(), "catalog"), [], [("p_type", "asc")], [], "tipo_id")
    return part.join(kinds, "p_type", "left").select("p_partkey", "p_name", "tipo_id")


def multi_column_key(spark, sf):
    """Line pairs looked up by (order, part): join on two columns after removing repeats."""
    lines = table(spark, sf, "lineitem")
    returned = lines.where("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct().withColumn("devuelta", F.lit(True))
    pairs = lines.select("l_orderkey", "l_partkey").distinct()
    return pairs.join(returned, ["l_orderkey", "l_partkey"], "left").withColumn("devuelta", F.coalesce("devuelta", F.lit(False)))


# ---------------------------------------------------------------------------- aggregates


def agg_basic(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy("event_type")
        .agg(
            rounded_mean("value").alias("promedio"),
            F.min("value").alias("minimo"),
            F.max("value").alias("maximo"),
            F.count(F.lit(1)).alias("cantidad"),
        )
        .orderBy("event_type")
    )


def agg_multi_key(spark, sf):
    """Mean order value by region, nation and segment, reduced per customer before the dimensions."""
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    per_owner = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(28,6)")).alias("total"), F.count(F.lit(1)).alias("n")
    )
    return (
        per_owner.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name", "c_mktsegment")
        .agg(quotient(F.sum("total"), F.sum("n")).alias("promedio"), F.sum("n").alias("cantidad"))
    )


def value_by_model_through_bridge(spark, sf):
    """Order value per part over the distinct (order, part) bridge: an order counts for each of its parts."""
    bridge = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    per_part = (
        bridge.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_partkey")
        .agg(exact_mean("o_totalprice").alias("promedio"), F.count(F.lit(1)).alias("cantidad"))
    )
    return per_part.join(part, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "p_name", "p_type", "promedio", "cantidad")


def having_min(spark, sf):
    per_owner = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("pedidos"))
    return per_owner.where(F.col("pedidos") >= 12)


def first_per_group(spark, sf):
    """Owner name of each measured user (lowest event wins), users with two or more measurements."""
    events = table(spark, sf, "events").where("event_type = 'purchase'")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return (
        events.join(customer, F.col("user_id") == F.col("c_custkey"))
        .groupBy("user_id")
        .agg(
            F.min_by("c_name", "event_id").alias("propietario"),
            F.count(F.lit(1)).alias("cantidad"),
            exact_mean("value").alias("promedio"),
        )
        .where(F.col("cantidad") >= 2)
        .orderBy(F.desc("promedio"), "user_id")
    )


def conditional_counts(spark, sf):
    rule = (F.col("value") < 1) | (F.col("value") > 200)
    return (
        table(spark, sf, "events")
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("recibidas"),
            F.count_if(~rule).alias("aceptadas"),
            F.count_if(rule).alias("rechazadas"),
            F.coalesce(F.sum(F.when(rule, F.col("value").cast("decimal(18,2)"))), F.lit(0)).cast("double").alias("valor_rechazado"),
        )
    )


def distinct_rows(spark, sf):
    return table(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


def global_counts(spark, sf):
    return table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("filas"), F.count(F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("no_nulas")
    )


def profile(spark, sf):
    """Every column of the orders with its type's measures; the approximate ones are left to ``column_profile``."""
    profiled = column_profile(table(spark, sf, "orders"))
    return profiled.select(
        "columna", "filas", "nulos", "minimo", "maximo", "primero", "ultimo", rounded(F.col("media")).alias("media"), rounded(F.col("desviacion"), 2).alias("desviacion")
    )


def dup_at_grain(spark, sf):
    return repeated_at(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


def fact_mean_by_day(spark, sf):
    """The fact is reduced per day and type; a date dimension then names the days left."""
    events = table(spark, sf, "events").withColumn("fecha", F.to_date("ts"))
    dim = events.select("fecha").distinct().select(*calendar_columns("fecha"))
    reduced = events.groupBy("fecha", "event_type").agg(
        rounded_mean("value").alias("promedio"), F.count(F.lit(1)).alias("mediciones")
    )
    return (
        reduced.join(dim, "fecha")
        .select("fecha_key", "fecha", "trimestre", F.col("event_type").alias("metrica"), "promedio", "mediciones")
        .orderBy("fecha", "metrica")
    )


# ------------------------------------------------------------------------------- windows


def row_number_part(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return add_row_number(events, ["event_type"], [("value", "desc")], ["event_id"])


def rank_part(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return add_rank(events, ["event_type"], [("value", "desc")], rank="posicion")


def dense_rank_global(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return add_rank(events, [], [("value", "desc")], rank="rango", dense_rank="rango_denso")


def row_number_global(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return add_row_number(orders, [], [("o_totalprice", "desc")], ["o_orderkey"])


def avg_over_diff(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return with_group_value(events, ["event_type"], media=exact_mean("value")).select(
        "event_id",
        "event_type",
        "value",
        rounded(F.col("media")).alias("promedio"),
        rounded(F.col("value") - F.col("media")).alias("diferencia"),
    )


# ------------------------------------------------------------------- sorts, limits, unions


def topk(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(orders, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 10)


def nulls_last(spark, sf):
    """Largest line of every order, orders without a line after all others."""
    best = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("mayor"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    joined = orders.join(best, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "mayor")
    ranked = add_row_number(joined, [], [("mayor", "desc")], ["o_orderkey"])
    return ranked.orderBy(F.desc_nulls_last("mayor"), "o_orderkey")


def union_all_counts(spark, sf):
    parts = [table(spark, sf, n).agg(F.count(F.lit(1)).alias("cantidad")).select(F.lit(n).alias("objeto"), "cantidad") for n in TABLES]
    return reduce(DataFrame.unionByName, parts)


def union_distinct_dates(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("fecha"))
    events = table(spark, sf, "events").select(F.to_date("ts").alias("fecha"))
    return orders.union(events).distinct()


def calendar_key(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("fecha")).distinct()
    return days.select(*calendar_columns("fecha"))


_MEAN = "CAST(SUM(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) / COUNT({c})"
_BIG = "SELECT * FROM orders WHERE o_totalprice > 450000"

QUERIES = {
    "fact_mean_by_day": (
        fact_mean_by_day,
        "SELECT CAST(year(f) * 10000 + month(f) * 100 + day(f) AS INTEGER) AS fecha_key, f AS fecha, CAST(quarter(f) AS SMALLINT) AS trimestre, metrica, promedio, mediciones "
        f"FROM (SELECT CAST(ts AS DATE) AS f, event_type AS metrica, CAST(round(CAST({_MEAN.format(c='value')} AS DECIMAL(28,10)), 4) AS DOUBLE) AS promedio, COUNT(*) AS mediciones FROM events GROUP BY 1, 2) t ORDER BY fecha, metrica",
    ),
    "project_filter": (
        project_filter,
        "SELECT o_orderkey AS pedido, o_custkey AS cliente, o_totalprice AS importe FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000",
    ),
    "all_but_some_columns": (all_but_some_columns, "SELECT * EXCLUDE (s_acctbal) FROM supplier"),
    "label_and_computed": (
        label_and_computed,
        "SELECT 'lineitem' AS entidad, l_orderkey, l_partkey, l_linenumber, "
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS neto FROM lineitem",
    ),
    "in_list_null_like": (
        in_list_null_like,
        "SELECT p_partkey, p_brand, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_brand LIKE 'Brand#1%' AND p_name IS NOT NULL",
    ),
    "not_in_or": (not_in_or, "SELECT p_partkey, p_type, p_size FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO') OR p_size >= 45"),
    "half_open_range": (
        half_open_range,
        "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' ORDER BY ts, event_id",
    ),
    "above_global_avg": (
        above_global_avg,
        f"SELECT event_id, event_type, value FROM events WHERE value > (SELECT {_MEAN.format(c='value')} FROM events)",
    ),
    "point_lookup": (point_lookup, "SELECT * FROM orders WHERE o_orderkey = 77 LIMIT 1"),
    "visible_text": (
        visible_text,
        "SELECT p_partkey, '[' || p_name || ']' AS nombre_visible, '[' || coalesce(nullif(p_type, 'PROMO'), 'NULL') || ']' AS tipo_visible FROM part",
    ),
    "inner_two": (
        inner_two,
        "SELECT o_orderkey, o_orderpriority, l_partkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    ),
    "path_join": (
        path_join,
        "SELECT r_name, n_name, c_name, o_orderkey, p_name, p_type, l_linenumber, l_quantity FROM region JOIN nation ON n_regionkey = r_regionkey "
        "JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey",
    ),
    "compound_on": (
        compound_on,
        f"SELECT r_name, n_name, CAST(round(CAST({_MEAN.format(c='value')} AS DECIMAL(28,10)), 4) AS DOUBLE) AS promedio, COUNT(*) AS mediciones FROM events "
        "JOIN customer ON c_custkey = user_id AND c_mktsegment = 'BUILDING' JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2",
    ),
    "semi_join": (semi_join, f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM ({_BIG}) b)"),
    "anti_join_owner": (
        anti_join_owner,
        f"SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM ({_BIG}) b WHERE b.o_custkey = c_custkey)",
    ),
    "anti_join_child": (
        anti_join_child,
        "SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL",
    ),
    "left_zero_counts": (
        left_zero_counts,
        "SELECT o_orderkey, o_custkey, COUNT(l_orderkey) AS lineas FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2",
    ),
    "inner_then_left": (
        inner_then_left,
        "SELECT c_name, o_orderkey, COUNT(l_orderkey) AS lineas FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2",
    ),
    "full_outer_counts": (
        full_outer_counts,
        "SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.n, 0) AS devueltas, coalesce(b.n, 0) AS aceptadas FROM "
        "(SELECT l_orderkey, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a FULL OUTER JOIN "
        "(SELECT l_orderkey, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) b ON a.l_orderkey = b.l_orderkey",
    ),
    "surrogate_update": (
        surrogate_update,
        "SELECT p_partkey, p_name, t.id AS tipo_id FROM part JOIN (SELECT p_type, row_number() OVER (ORDER BY p_type) AS id FROM (SELECT DISTINCT p_type FROM part) d) t USING (p_type)",
    ),
    "multi_column_key": (
        multi_column_key,
        "SELECT p.l_orderkey, p.l_partkey, r.l_orderkey IS NOT NULL AS devuelta FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) p LEFT JOIN "
        "(SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R') r ON r.l_orderkey = p.l_orderkey AND r.l_partkey = p.l_partkey",
    ),
    "agg_basic": (
        agg_basic,
        f"SELECT event_type, CAST(round(CAST({_MEAN.format(c='value')} AS DECIMAL(28,10)), 4) AS DOUBLE) AS promedio, MIN(value) AS minimo, MAX(value) AS maximo, COUNT(*) AS cantidad FROM events GROUP BY 1 ORDER BY 1",
    ),
    "agg_multi_key": (
        agg_multi_key,
        f"SELECT r_name, n_name, c_mktsegment, CAST(round(CAST({_MEAN.format(c='o_totalprice')} AS DECIMAL(28,10)), 4) AS DOUBLE) AS promedio, COUNT(*) AS cantidad FROM orders JOIN customer ON c_custkey = o_custkey "
        "JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3",
    ),
    "value_by_model_through_bridge": (
        value_by_model_through_bridge,
        f"SELECT p_partkey, p_name, p_type, {_MEAN.format(c='o_totalprice')} AS promedio, COUNT(*) AS cantidad FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b "
        "JOIN orders ON o_orderkey = b.l_orderkey JOIN part ON p_partkey = b.l_partkey WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3",
    ),
    "having_min": (having_min, "SELECT o_custkey, COUNT(*) AS pedidos FROM orders GROUP BY 1 HAVING COUNT(*) >= 12"),
    "first_per_group": (
        first_per_group,
        f"SELECT user_id, arg_min(c_name, event_id) AS propietario, COUNT(*) AS cantidad, {_MEAN.format(c='value')} AS promedio FROM events "
        "JOIN customer ON c_custkey = user_id WHERE event_type = 'purchase' GROUP BY 1 HAVING COUNT(*) >= 2 ORDER BY promedio DESC, user_id",
    ),
    "conditional_counts": (
        conditional_counts,
        "SELECT event_type, COUNT(*) AS recibidas, CAST(count_if(NOT (value < 1 OR value > 200)) AS BIGINT) AS aceptadas, CAST(count_if(value < 1 OR value > 200) AS BIGINT) AS rechazadas, "
        "CAST(coalesce(SUM(CASE WHEN value < 1 OR value > 200 THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS valor_rechazado FROM events GROUP BY 1",
    ),
    "distinct_rows": (distinct_rows, "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer"),
    "global_counts": (global_counts, "SELECT COUNT(*) AS filas, COUNT(nullif(o_orderstatus, 'P')) AS no_nulas FROM orders"),
    "profile": (
        profile,
        " UNION ALL ".join(
            f"SELECT '{c}' AS columna, COUNT(*) AS filas, COUNT(*) - COUNT({c}) AS nulos, "
            + (
                f"CAST(MIN({c}) AS DOUBLE) AS minimo, CAST(MAX({c}) AS DOUBLE) AS maximo, CAST(NULL AS VARCHAR) AS primero, CAST(NULL AS VARCHAR) AS ultimo, "
                f"CAST(round(CAST({_MEAN.format(c=c)} AS DECIMAL(28,10)), 4) AS DOUBLE) AS media, round(stddev_samp({c}), 2) AS desviacion FROM orders"
                if number
                else f"CAST(NULL AS DOUBLE) AS minimo, CAST(NULL AS DOUBLE) AS maximo, CAST(MIN({c}) AS VARCHAR) AS primero, CAST(MAX({c}) AS VARCHAR) AS ultimo, "
                "CAST(NULL AS DOUBLE) AS media, CAST(NULL AS DOUBLE) AS desviacion FROM orders"
            )
            for c, number in (("o_orderkey", 1), ("o_custkey", 1), ("o_orderstatus", 0), ("o_totalprice", 1), ("o_orderdate", 0), ("o_orderpriority", 0))
        ),
    ),
    "dup_at_grain": (dup_at_grain, "SELECT l_orderkey, l_partkey, COUNT(*) AS veces FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"),
    "row_number_part": (
        row_number_part,
        "SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS posicion FROM events",
    ),
    "rank_part": (rank_part, "SELECT event_id, event_type, value, rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS posicion FROM events"),
    "dense_rank_global": (
        dense_rank_global,
        "SELECT event_id, value, rank() OVER (ORDER BY value DESC) AS rango, dense_rank() OVER (ORDER BY value DESC) AS rango_denso FROM events",
    ),
    "row_number_global": (
        row_number_global,
        "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS posicion FROM orders",
    ),
    "avg_over_diff": (
        avg_over_diff,
        f"SELECT event_id, event_type, value, CAST(round(CAST(media AS DECIMAL(28,10)), 4) AS DOUBLE) AS promedio, CAST(round(CAST(value - media AS DECIMAL(28,10)), 4) AS DOUBLE) AS diferencia FROM events "
        f"JOIN (SELECT event_type AS k, {_MEAN.format(c='value')} AS media FROM events GROUP BY 1) m ON k = event_type",
    ),
    "topk": (topk, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
    "nulls_last": (
        nulls_last,
        "SELECT o_orderkey, mayor, row_number() OVER (ORDER BY mayor DESC NULLS LAST, o_orderkey) AS posicion FROM orders LEFT JOIN "
        "(SELECT l_orderkey, MAX(l_extendedprice) AS mayor FROM lineitem GROUP BY 1) m ON l_orderkey = o_orderkey",
    ),
    "union_all_counts": (
        union_all_counts,
        " UNION ALL ".join(f"SELECT '{n}' AS objeto, COUNT(*) AS cantidad FROM {n}" for n in TABLES),
    ),
    "union_distinct_dates": (union_distinct_dates, "SELECT CAST(o_orderdate AS DATE) AS fecha FROM orders UNION SELECT CAST(ts AS DATE) FROM events"),
    "calendar_key": (
        calendar_key,
        "SELECT DISTINCT CAST(year(f) * 10000 + month(f) * 100 + day(f) AS INTEGER) AS fecha_key, f AS fecha, CAST(year(f) AS SMALLINT) AS anio, CAST(month(f) AS SMALLINT) AS mes, "
        "CAST(day(f) AS SMALLINT) AS dia, CAST(quarter(f) AS SMALLINT) AS trimestre FROM (SELECT CAST(o_orderdate AS DATE) AS f FROM orders) d",
    ),
}

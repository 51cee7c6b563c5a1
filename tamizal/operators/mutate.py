"""Inserts, updates and deletes as functions from one snapshot to the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamizal.functions import arrays
from tamizal.operators.ranking import add_row_number


class DuplicateKeyError(ValueError):
    """A row to insert has a key that is already taken."""


def holds(test: Column) -> Column:
    """A test that is NULL does not hold."""
    return F.coalesce(test, F.lit(False))


def update_where(df: DataFrame, test: Column | None, values: dict[str, Column]) -> DataFrame:
    """Set ``values`` where ``test`` holds (everywhere without one); every value sees the old row."""
    changed = {
        name: value.cast(df.schema[name].dataType)
        if test is None
        else F.when(holds(test), value.cast(df.schema[name].dataType)).otherwise(F.col(name))
        for name, value in values.items()
    }
    return df.withColumns(changed)


def delete_where(df: DataFrame, test: Column) -> DataFrame:
    return df.where(~holds(test))


def _current(df: DataFrame, name: str) -> Column:
    """The column, or NULL for one that no row has yet."""
    return F.col(name) if name in df.columns else F.lit(None)


def set_field(df: DataFrame, path: str, value: Column, test: Column | None = None) -> DataFrame:
    """Set a field, also a new one or one inside structs (``dataset.nombre``)."""
    head, _, inner = path.partition(".")
    changed = F.col(head).withField(inner, value) if inner else value
    return df.withColumn(head, changed if test is None else F.when(holds(test), changed).otherwise(_current(df, head)))


def change_array(df: DataFrame, name: str, change: Callable[[Column], Column], test: Column | None = None) -> DataFrame:
    current = _current(df, name)
    changed = change(current)
    return df.withColumn(name, changed if test is None else F.when(holds(test), changed).otherwise(current))


def add_to_set(df: DataFrame, name: str, element: Column, test: Column | None = None) -> DataFrame:
    return change_array(df, name, lambda a: arrays.add_to_set(a, element), test)


def push(df: DataFrame, name: str, element: Column, test: Column | None = None) -> DataFrame:
    return change_array(df, name, lambda a: arrays.push(a, element), test)


def pull(df: DataFrame, name: str, drop: Callable[[Column], Column], test: Column | None = None) -> DataFrame:
    return change_array(df, name, lambda a: arrays.pull(a, drop), test)


def copy_row(df: DataFrame, test: Column, values: dict[str, Column]) -> DataFrame:
    """Rows that meet ``test`` with some columns replaced."""
    return update_where(df.where(holds(test)), None, values)


def counted(df: DataFrame, test: Column) -> tuple[DataFrame, Observation]:
    """``df`` plus counters filled while it is written: rows matched by ``test`` and rows seen."""
    seen = Observation()
    return df.observe(seen, F.count_if(holds(test)).alias("matched"), F.count(F.lit(1)).alias("scanned")), seen


def counted_update(df: DataFrame, test: Column | None, values: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``update_where`` with counters filled while it is written: rows ``matched``, ``modified`` and ``scanned``.

    A matched row is modified when one of its values really changes, null counting as a value; one pass.
    """
    changed = update_where(df, test, values)
    old = {name: f"_old_{i}" for i, name in enumerate(values)}
    both = df.withColumns({o: F.col(n) for n, o in old.items()})
    both = both.withColumn("_matched", holds(test) if test is not None else F.lit(True))
    both = update_where(both, None if test is None else F.col("_matched"), values)
    differs = reduce(or_, [~_comparable(df, n, n).eqNullSafe(_comparable(df, n, o)) for n, o in old.items()])
    seen = Observation()
    watched = both.observe(
        seen, F.count_if("_matched").alias("matched"), F.count_if(F.col("_matched") & differs).alias("modified"), F.count(F.lit(1)).alias("scanned")
    )
    return watched.select(*changed.columns), seen


def _comparable(df: DataFrame, name: str, column: str) -> Column:
    """Maps and variants have no equality of their own: they are compared as JSON text, maps by sorted entries."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)))
    return F.to_json(F.col(column)) if isinstance(kind, T.VariantType) else F.col(column)


def insert_rows(df: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Append ``new``; a key already taken, or sent twice, raises."""
    taken = new.select(*key).join(df.select(*key), key, "left_semi")
    twice = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
    clash = taken.union(twice).limit(5).collect()
    if clash:
        raise DuplicateKeyError(f"duplicate key {key}: {[tuple(r) for r in clash]}")
    return df.unionByName(new, allowMissingColumns=True)


def seed_if_absent(df: DataFrame, candidates: DataFrame, key: list[str]) -> DataFrame:
    """Append the candidates of every key that has no row yet."""
    return df.unionByName(candidates.join(df.select(*key).distinct(), key, "left_anti").select(*df.columns))


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """A few rows written out; ``defaults`` fill columns that came NULL."""
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.coalesce(F.col(c), d.cast(schema[c].dataType)) for c, d in (defaults or {}).items()})


def assign_ids(new: DataFrame, existing: DataFrame, natural_key: list[str], id_column: str = "id") -> DataFrame:
    """Ids after the highest taken one, in natural-key order, the same on every run."""
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("m")).scalar()
    order = [(c, "asc") for c in natural_key]
    numbered = add_row_number(new.drop(id_column), [], order, [], "_n")
    kind = existing.schema[id_column].dataType
    rest = [c for c in new.columns if c != id_column]
    return numbered.select((F.col("_n") + top).cast(kind).alias(id_column), *rest)


def catalog_from(df: DataFrame, column: str, name: str = "nombre") -> DataFrame:
    """Catalog of the distinct values of a column, ids in value order."""
    values = df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()
    return add_row_number(values, [], [(name, "asc")], [], "id").select("id", name)


def resolve_key(df: DataFrame, parents: DataFrame, column: str, natural_key: str, id_column: str, as_name: str) -> DataFrame:
    """Replace a natural key by the id of its parent; none gives NULL, more than one fails the job."""
    single = parents.groupBy(F.col(natural_key).alias("_natural")).agg(
        F.min(id_column).alias("_id"), F.count(F.lit(1)).alias("_n")
    )
    message = F.format_string("more than one row for %s", F.col("_natural").cast("string"))
    checked = single.select(
        "_natural", F.when(F.col("_n") > 1, F.raise_error(message).cast("bigint")).otherwise(F.col("_id")).alias(as_name)
    )
    return df.join(checked, F.col(column) == F.col("_natural"), "left").drop("_natural", column)


def classify(df: DataFrame, column: str, mapping: dict[str, str], catalog: DataFrame, as_name: str) -> DataFrame:
    """Category id of a free text through a mapping text -> category; unmapped text gives NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    known = catalog.select(F.col("nombre").alias("_category"), F.col("id").alias(as_name))
    category = F.try_element_at(F.create_map(*pairs), F.col(column))
    return df.withColumn("_c", category).join(known, F.col("_c") == F.col("_category"), "left").drop("_c", "_category")


def unclassified(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def normalize_column(df: DataFrame, column: str, mapping: dict[str, str], catalog: DataFrame, as_name: str, detail: str) -> DataFrame:
    """Free text -> category id, the text itself kept as ``detail``, the old column dropped."""
    return classify(df.withColumn(detail, F.col(column)), column, mapping, catalog, as_name).drop(column)


def set_by_key(df: DataFrame, values: DataFrame, key: list[str], column: str) -> DataFrame:
    """Set ``column`` on the rows whose key appears in ``values``."""
    right = values.select(*key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    current = F.col(column) if column in df.columns else F.lit(None).cast(values.schema[column].dataType)
    joined = df.join(right, key, "left")
    return joined.withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(current)).drop("_new", "_hit")


def add_column(df: DataFrame, name: str, kind: str | T.DataType) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)

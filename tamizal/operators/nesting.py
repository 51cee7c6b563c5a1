"""Rows into documents and back: arrays of children, lookups into arrays, expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest(children: DataFrame, key: list[str], elements: list[str], name: str, order_by: list[str]) -> DataFrame:
    """``key`` and the array ``name`` of structs ``elements`` sorted by ``order_by``: one row per key.

    The array is the result, whatever its length. A question about elements that does not ask for the
    array is better asked of the children (``elements_meet``, ``first_element``), which are reduced
    before they move and never gathered. ``order_by`` should tell the children of a key apart.
    """
    fields = [*order_by, *(e for e in elements if e not in order_by)]
    nested = children.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
    if fields == elements:
        return nested
    return nested.withColumn(name, F.transform(name, lambda x: F.struct(*[x[e].alias(e) for e in elements])))


def elements_meet(children: DataFrame, key: list[str], *conditions: Column) -> DataFrame:
    """Keys with, for every condition, an element that meets it; the elements may differ."""
    flags = [F.coalesce(F.bool_or(c), F.lit(False)).alias(f"_met_{i}") for i, c in enumerate(conditions)]
    met = F.lit(True)
    for i in range(len(conditions)):
        met = met & F.col(f"_met_{i}")
    return children.groupBy(*key).agg(*flags).where(met).select(*key)


def first_element(children: DataFrame, key: list[str], condition: Column, order_by: list[str], fields: list[str]) -> DataFrame:
    """The first element by ``order_by`` that meets ``condition``, for every key that has one."""
    ordered = F.struct(*order_by, *[f for f in fields if f not in order_by])
    return children.where(condition).groupBy(*key).agg(F.min(ordered).alias("_first")).select(*key, *[f"_first.{f}" for f in fields])


def lookup(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str, elements: list[str], order_by: list[str]
) -> DataFrame:
    """Array of the matching rows of ``right`` beside every row of ``left``; no match, empty array."""
    nested = nest(right.withColumnRenamed(right_key, "_key"), ["_key"], elements, name, order_by)
    joined = left.join(nested, F.col(left_key) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(name, F.coalesce(name, F.from_json(F.lit("[]"), nested.schema[name].dataType)))


def lookup_unwind(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """Lookup whose array is expanded at once: a plain inner join, no array is built."""
    return left.join(right, on, "inner")


def unwind(df: DataFrame, array: str, as_name: str | None = None) -> DataFrame:
    """One row per element; an empty or absent array gives none."""
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, F.explode(array).alias(as_name or array))


def dangling(documents: DataFrame, array: str, field: str, referenced: DataFrame, key: str) -> DataFrame:
    """Elements whose reference is not in ``referenced``."""
    elements = documents.select(F.explode(array).alias("_e")).select(F.col(f"_e.{field}").alias(field))
    return elements.join(referenced.select(F.col(key).alias("_known")), F.col(field) == F.col("_known"), "left_anti")


def value_map(rows: DataFrame, key: list[str], name_column: str, value_column: str, name: str, latest_by: str) -> DataFrame:
    """Map of named values per key; a name written twice keeps the value with the highest ``latest_by``.

    Repeats are removed by a partial aggregate first, so a map holds one entry per distinct name. A value
    without a name has no place in a map and is left out.
    """
    named = rows.where(F.col(name_column).isNotNull())  # a map has no null key
    single = named.groupBy(*key, name_column).agg(F.max_by(value_column, latest_by).alias("_v"))
    entries = F.collect_list(F.struct(F.col(name_column), F.col("_v")))
    return single.groupBy(*key).agg(F.map_from_entries(F.sort_array(entries)).alias(name))

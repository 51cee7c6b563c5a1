"""Shape rules for documents that arrive as JSON text: required fields, types, minimum sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamizal.functions.jsonb import parse

_KINDS = {
    "string": lambda kind, node: kind == "STRING",
    "bool": lambda kind, node: kind == "BOOLEAN",
    "object": lambda kind, node: F.startswith(kind, F.lit("OBJECT")),
    "array": lambda kind, node: F.startswith(kind, F.lit("ARRAY")),
    "int": lambda kind, node: kind == "BIGINT",
    "number": lambda kind, node: kind.rlike(r"^(BIGINT|DECIMAL|DOUBLE)"),
    # JSON has no date type: a date is a string that reads as one
    "date": lambda kind, node: (kind == "STRING") & F.try_variant_get(node, "$", "string").try_cast("date").isNotNull(),
}


def _rules(node: Column, schema: dict, path: str) -> list[tuple[str, Column]]:
    """(rule, broken) pairs; a rule on an absent field is the business of ``required`` alone."""
    out = []
    kind = F.schema_of_variant(node)
    if "bsonType" in schema:
        right = _KINDS[schema["bsonType"]](kind, node)
        out.append((f"{path}:bsonType", node.isNotNull() & ~F.coalesce(right, F.lit(False))))
    is_object = F.startswith(kind, F.lit("OBJECT"))
    for name in schema.get("required", ()):
        child = F.try_variant_get(node, f"$['{name}']", "variant")
        out.append((f"{path}.{name}:required", is_object & child.isNull()))
    if "minLength" in schema:
        text = F.try_variant_get(node, "$", "string")
        out.append((f"{path}:minLength", (kind == "STRING") & (F.length(text) < schema["minLength"])))
    if "minItems" in schema:
        items = F.try_variant_get(node, "$", "array<variant>")
        out.append((f"{path}:minItems", F.startswith(kind, F.lit("ARRAY")) & (F.size(items) < schema["minItems"])))
    for name, inner in schema.get("properties", {}).items():
        out += _rules(F.try_variant_get(node, f"$['{name}']", "variant"), inner, f"{path}.{name}")
    return out


def document_violations(df: DataFrame, text: str, schema: dict, keep: list[str]) -> DataFrame:
    """One row per document and broken rule: ``keep`` columns and ``regla``."""
    parsed = df.withColumn("_doc", parse(text))
    rules = _rules(F.col("_doc"), schema, "$")
    found = F.array(
        F.when(F.col("_doc").isNull(), F.lit("$:json")),
        *[F.when(F.coalesce(broken, F.lit(False)), F.lit(rule)) for rule, broken in rules],
    )
    return parsed.select(*keep, F.explode(F.array_compact(found)).alias("regla"))


def valid_documents(df: DataFrame, text: str, schema: dict) -> DataFrame:
    parsed = df.withColumn("_doc", parse(text))
    broken = [F.coalesce(b, F.lit(False)) for _, b in _rules(F.col("_doc"), schema, "$")]
    wrong = reduce(lambda a, b: a | b, broken, F.col("_doc").isNull())
    return parsed.where(~wrong).drop("_doc")

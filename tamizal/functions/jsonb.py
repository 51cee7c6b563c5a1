"""JSON operators over text or ``VARIANT``: field as text, key test, containment, build."""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_KINDS = "^(TINYINT|SMALLINT|INT|BIGINT)$"
DECIMAL_KINDS = r"^DECIMAL\(\d+,(\d+)\)$"
REAL_KINDS = "^(FLOAT|DOUBLE)$"
_MOST_DIGITS = 38


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse(text: Column | str) -> Column:
    """JSON text to ``VARIANT``; text that is not JSON becomes NULL."""
    return F.try_parse_json(_col(text))


def struct_text(*columns: str | Column) -> Column:
    """One JSON object per row, with absent values written as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _path(keys: tuple[str, ...]) -> str:
    escaped = (k.replace("\\", "\\\\").replace("'", "\\'") for k in keys)
    return "$" + "".join(f"['{k}']" for k in escaped)


def field(value: Column | str, *keys: str, kind: str = "string") -> Column:
    """Value at a path of a ``VARIANT``; NULL when absent, JSON null or of another kind."""
    return F.try_variant_get(_col(value), _path(keys), kind)


def field_text(text: Column | str, *keys: str) -> Column:
    """Value at a path as text, from JSON text."""
    return field(parse(text), *keys)


def has_key(text: Column | str, key: str) -> Column:
    """True when the top-level object has ``key``, whatever its value (JSON null included)."""
    return F.coalesce(F.array_contains(F.json_object_keys(_col(text)), key), F.lit(False))


def contains(value: Column | str, fragment: str | dict | list) -> Column:
    """True when ``value`` (a ``VARIANT``) contains the JSON ``fragment`` at its top level.

    The literal fragment is unfolded while the plan is built: every object key becomes a path
    test, every array element an ``exists`` over the array of the row.
    """
    wanted = json.loads(fragment, parse_float=Decimal) if isinstance(fragment, str) else fragment
    return F.coalesce(_contains(_col(value), wanted), F.lit(False))


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _element_test(wanted):
    return lambda element: F.coalesce(_contains(element, wanted), F.lit(False))


def _contains(node: Column, wanted) -> Column:
    # a path into something that is no object, or elements of something that is no array, are
    # NULL: only an empty fragment has to ask for the kind
    if isinstance(wanted, dict):
        if not wanted:
            return F.startswith(F.schema_of_variant(node), F.lit("OBJECT"))
        return _all([_contains(F.try_variant_get(node, _path((k,)), "variant"), v) for k, v in wanted.items()])
    if isinstance(wanted, list):
        if not wanted:
            return F.startswith(F.schema_of_variant(node), F.lit("ARRAY"))
        items = F.try_variant_get(node, "$", "array<variant>")
        return _all([F.exists(items, _element_test(w)) for w in wanted])
    if wanted is None:
        return F.is_variant_null(node)
    # the cheap value test goes first; "7" reads as the number 7, so the kind is compared too
    if isinstance(wanted, bool):
        return (F.try_variant_get(node, "$", "boolean") == F.lit(wanted)) & (F.schema_of_variant(node) == "BOOLEAN")
    if isinstance(wanted, (int, float, Decimal)):
        return _same_number(node, Decimal(str(wanted)))
    return (F.try_variant_get(node, "$", "string") == F.lit(wanted)) & (F.schema_of_variant(node) == "STRING")


def _same_number(node: Column, wanted: Decimal) -> Column:
    """Equal as numbers, compared in the kind the row has: integers and decimals exactly, doubles as doubles."""
    kind = F.schema_of_variant(node)
    real = kind.rlike(REAL_KINDS) & (F.try_variant_get(node, "$", "double") == F.lit(float(wanted)))
    whole = wanted == wanted.to_integral_value()
    tests = [real]
    if whole and -(1 << 63) <= wanted < 1 << 63:
        tests.append(kind.rlike(INTEGER_KINDS) & (F.try_variant_get(node, "$", "bigint") == F.lit(int(wanted))))
    digits = wanted.normalize().as_tuple()
    scale = max(0, -digits.exponent)
    before = max(len(digits.digits) + digits.exponent, 1)
    if scale + before <= _MOST_DIGITS:
        # a scale that holds the literal and what the row may have behind the point; wider ones are not equal
        held = _MOST_DIGITS - before
        places = F.coalesce(F.regexp_extract(kind, DECIMAL_KINDS, 1).try_cast("int"), F.lit(_MOST_DIGITS + 1))
        exact = F.try_variant_get(node, "$", f"decimal({_MOST_DIGITS},{held})") == F.lit(format(wanted, "f")).cast(f"decimal({_MOST_DIGITS},{held})")
        tests.append((places <= held) & exact)
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])

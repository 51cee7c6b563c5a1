"""Operators on arrays of structs: match, first match, set-add, append, pull."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def any_element(array: Column | str, test: Callable[[Column], Column]) -> Column:
    """True when one element meets ``test``; conditions joined inside it hold for that same element."""
    return F.coalesce(F.exists(_col(array), test), F.lit(False))


def first_match(array: Column | str, test: Callable[[Column], Column]) -> Column:
    """Array with only the first element that meets ``test``."""
    return F.slice(F.filter(_col(array), test), 1, 1)


def is_empty(array: Column | str) -> Column:
    return F.coalesce(F.size(_col(array)) == 0, F.lit(True))


def _or_empty(array: Column, element: Column) -> Column:
    none = F.filter(F.array(element), lambda _: F.lit(False))
    return F.coalesce(array, none)


def add_to_set(array: Column | str, element: Column) -> Column:
    """Append ``element`` unless it is present; duplicates already there are left alone."""
    current = _or_empty(_col(array), element)
    return F.when(F.array_contains(current, element), current).otherwise(F.array_append(current, element))


def push(array: Column | str, element: Column) -> Column:
    return F.array_append(_or_empty(_col(array), element), element)


def pull(array: Column | str, test: Callable[[Column], Column]) -> Column:
    """Drop every element that meets ``test``; a test that is NULL keeps the element."""
    return F.filter(_col(array), lambda x: ~F.coalesce(test(x), F.lit(False)))

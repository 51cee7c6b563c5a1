"""Join and aggregate shapes that keep the shuffle small: reduce first, join what is left."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _added(value: str | Column) -> tuple[Column, Column, Column, Column]:
    """Sums of a numeric value in three parts, and how many values there are.

    Every value is taken apart the same way: what eighteen decimals below 1e18 hold, else the integer that
    38 digits hold, and as a double what neither holds (a longer fraction, a larger number, NaN, infinity).
    The decimal sums are exact and do not depend on the order rows arrive in.
    """
    column = F.col(value) if isinstance(value, str) else value
    number = column.cast("double")
    size = F.abs(number)
    fine = F.when(size < 1e18, column.try_cast("decimal(38,18)"))
    large = F.when((size >= 1e18) & (size < 1e37), column.try_cast("decimal(38,0)"))
    held = F.coalesce(fine.cast("double"), large.cast("double"), F.lit(0.0))
    rest = F.when(F.isnan(number) | (size == float("inf")), number).otherwise(number - held)
    nought = F.lit(0).cast("decimal(38,18)")
    return F.coalesce(F.try_sum(fine), nought), F.coalesce(F.try_sum(large), F.lit(0).cast("decimal(38,0)")), F.coalesce(F.sum(rest), F.lit(0.0)), F.count(column)


def exact_mean(value: str | Column) -> Column:
    """Mean of a numeric value, as a double; nothing is cut off, and one path is taken whatever the values are."""
    fine, large, rest, count = _added(value)
    n = F.nullif(count, F.lit(0))
    return fine.cast("double") / n + (large.cast("double") / n + rest / n)


def rounded_mean(value: str | Column, digits: int = 4) -> Column:
    """Mean rounded once, half away from zero, from the exact quotient of sum and count; as a double."""
    fine, large, rest, count = _added(value)
    n = F.nullif(count, F.lit(0))
    return quotient(fine, n, digits) + (F.round(large.cast("double") / n, digits) + F.round(rest / n, digits))


def quotient(total: Column, count: Column, digits: int = 4) -> Column:
    """``total / count`` rounded once, half away from zero, as a double; null where either is null.

    ``total`` is a decimal of at most twenty digits before the point and eighteen behind it, ``count`` a positive
    integer below 1e12, ``digits`` at most six. Whole units are divided first, then what is left of them.
    """
    size = F.abs(total.cast("decimal(38,18)"))
    n = count.cast("decimal(12,0)")
    whole = F.floor(size).cast("decimal(20,0)")
    units = F.call_function("div", whole, n)
    left = ((whole % n).cast("decimal(12,0)") + (size - whole).cast("decimal(18,18)")).cast("decimal(30,18)")
    scaled = (left * F.lit(Decimal(10**digits)).cast(f"decimal({digits + 1},0)")).cast("decimal(36,18)")
    parts = F.call_function("div", (scaled + scaled).cast("decimal(37,18)") + n, (n + n))
    shown = units.cast("decimal(20,0)") + parts.cast(f"decimal({digits + 2},0)") * F.lit(Decimal(1).scaleb(-digits))
    return F.when(total < 0, -shown).otherwise(shown).cast("double")


def rounded(value: Column, digits: int = 4) -> Column:
    """Half up on the decimal digits that a number is shown with, as ``NUMERIC`` rounds; once, at any size."""
    return F.round(value.cast("double"), digits)


def count_children(parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str) -> DataFrame:
    """Children per parent with zero kept: children are counted before they meet the parents."""
    counted = children.groupBy(F.col(child_key).alias("_child")).agg(F.count(F.lit(1)).alias(name))
    joined = parents.join(counted, F.col(key) == F.col("_child"), "left").drop("_child")
    return joined.withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


def without_match(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    return left.join(right, on, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    return left.join(right, on, "left_semi")


def repeated_at(df: DataFrame, grain: list[str], name: str = "veces") -> DataFrame:
    """Combinations of ``grain`` that occur more than once."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def visible(column: str, absent: str | None = None) -> Column:
    """Text between brackets, so that blanks at the ends show."""
    value = F.col(column) if absent is None else F.coalesce(column, F.lit(absent))
    return F.concat(F.lit("["), value, F.lit("]"))

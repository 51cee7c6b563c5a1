"""Row numbers and ranks whose work stays balanced when one partition holds most of the rows.

A plain window sends each of its partitions to one task, and a window without partitions sends
everything to one. Here the rows are dealt into ordered ranges by their whole sort key, numbered
inside each range, and shifted by the number of rows of the same partition in earlier ranges.
The ranges are those of Spark's own range exchange: they decide only the balance, the shifts are
exact counts, and the same path is taken at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamizal.session import materialize

Order = tuple[str, str]  # (column, "asc" | "desc")


def _distinct_names(order_by: list[Order]) -> list[Order]:
    """A column that is named again does not change the order."""
    first: dict[str, Order] = {}
    for name, direction in order_by:
        first.setdefault(name, (name, direction))
    return list(first.values())


def _window_order(order_by: list[Order]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if d == "asc" else F.col(c).desc_nulls_last() for c, d in order_by]


def ranged(df: DataFrame, order_by: list[Order], ranges: int | None = None) -> DataFrame:
    """``df`` written in the order asked for: ``_bucket`` is the range, ``_place`` the place in it.

    ``ranges`` is left to the session's number of shuffle partitions unless given.
    """
    order = _window_order(order_by)
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    number = F.monotonically_increasing_id()  # the task above bit 33, the row in it below
    placed = dealt.sortWithinPartitions(*order).withColumn("_number", number)
    return materialize(
        placed.withColumns({"_bucket": F.shiftright("_number", 33), "_place": F.col("_number").bitwiseAND((1 << 33) - 1)}).drop("_number"),
        "ranged",
    )


def _joined(df: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the other columns of ``right``, which has at most one row per ``keys``; nulls are equal."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return df.join(named, same, "left").drop(*[f"_r_{k}" for k in keys])


def _before(per_range: DataFrame, partition_by: list[str], totals: list[str]) -> DataFrame:
    """``_shift_*``: totals of the same partition over earlier ranges (one row per partition and range)."""
    earlier = Window.partitionBy(*partition_by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.withColumns({f"_shift_{n}": F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in totals})


def add_row_number(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[Order],
    tiebreak: list[str],
    name: str = "posicion",
    ranges: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by .. order by .., tiebreak)``; ``tiebreak`` makes rows unique.

    Rows move once, by their sort key. ``df`` is read a second time by Spark to sample the ranges.
    """
    order = _distinct_names([*((p, "asc") for p in partition_by), *order_by, *((t, "asc") for t in tiebreak)])
    placed = ranged(df, order, ranges)
    # rows of a partition stand together in a range: its first place there is where its numbers start
    starts = placed.groupBy(*partition_by, "_bucket").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    shifts = _before(starts, partition_by, ["_rows"]).withColumn("_shift", F.col("_shift__rows") - F.col("_first"))
    shifts = materialize(shifts.select(*partition_by, "_bucket", "_shift"), "shifts")
    numbered = _joined(placed, shifts, [*partition_by, "_bucket"])
    return numbered.withColumn(name, (F.col("_place") + F.col("_shift") + 1).cast("bigint")).drop("_place", "_shift", "_bucket")


def add_rank(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[Order],
    rank: str | None = "rango",
    dense_rank: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``rank()`` and/or ``dense_rank()``: ties share a place, so distinct values are ranked.

    Rows are first counted per value (a partial aggregate, so a hot value costs nothing), the
    values are ranked, and the places are joined back to the rows.
    """
    value_columns = [c for c, _ in order_by]
    counted = df.groupBy(*partition_by, *value_columns).agg(F.count(F.lit(1)).alias("_rows"))
    order = _distinct_names([*((p, "asc") for p in partition_by), *order_by])
    values = ranged(counted, order, ranges)
    local = Window.partitionBy(*partition_by, "_bucket").orderBy("_place")
    placed = values.withColumn("_dense", F.row_number().over(local)).withColumn(
        "_rank", F.sum("_rows").over(local.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows") + 1
    )
    per_range = values.groupBy(*partition_by, "_bucket").agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("values"))
    shifts = materialize(_before(per_range, partition_by, ["rows", "values"]).drop("rows", "values"), "shifts")
    shifted = _joined(placed, shifts, [*partition_by, "_bucket"])
    places = materialize(
        shifted.select(
            *dict.fromkeys([*partition_by, *value_columns]),
            *([(F.col("_rank") + F.col("_shift_rows")).cast("bigint").alias(rank)] if rank else []),
            *([(F.col("_dense") + F.col("_shift_values")).cast("bigint").alias(dense_rank)] if dense_rank else []),
        ),
        "places",
    )
    return _joined(df, places, list(dict.fromkeys([*partition_by, *value_columns])))


def with_group_value(df: DataFrame, partition_by: list[str], **aggregates: Column) -> DataFrame:
    """``agg() over (partition by ..)`` beside each row, as a partial aggregate joined back."""
    totals = df.groupBy(*partition_by).agg(*[c.alias(n) for n, c in aggregates.items()])
    return _joined(df, materialize(totals, "group-values"), partition_by)


def top_k(df: DataFrame, order_by: list[Order], k: int) -> DataFrame:
    """First ``k`` rows: each task keeps ``k``, one task merges them."""
    order = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc() for c, d in order_by]
    return df.orderBy(*order).limit(k)

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tamizal.functions import cleaning as c


def one(spark, function, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", function("v").alias("x")).orderBy("i").collect()]


def test_tables_pair_up():
    assert len(c.ACCENTED) == len(c.PLAIN)


def test_text(spark):
    assert one(spark, c.clean_text, "  a   b ", " ", "", None) == ["a b", None, None, None]
    assert one(spark, lambda v: c.clean_text(v, collapse_inner=False), " a   b ") == ["a   b"]
    assert one(spark, c.strip_accents, "Métrica ÑANDÚ", "é") == ["Metrica NANDU", "e"]


def test_integer(spark):
    assert one(spark, c.safe_integer, " 7 ", "-3", "+4", "1.5", "x", "", None, "9" * 25) == [7, -3, 4, None, None, None, None, None]


def test_timestamp(spark):
    nine = dt.datetime(2026, 3, 5, 9, 0)
    given_ = ["2026-03-05T09:00:00Z", "2026-03-05T09:00:00+02:00", "5/3/2026 9:00:00", "2026/03/05 09:00:00", "2026-03-05 09:00"]
    assert one(spark, c.safe_timestamp, *given_) == [nine] * 5
    assert one(spark, c.safe_timestamp, "31/02/2026 09:00:00", "2026-02-30", "2026-03", "hoy", None) == [None] * 5


def test_date(spark):
    day = dt.date(2026, 3, 15)
    assert one(spark, c.safe_date, "2026-03-15", " 15/03/2026", "2026/3/15", "2026-03-15T10:00:00Z") == [day] * 4
    assert one(spark, c.safe_date, "31/02/2026", "15-03-2026", "2026-03", "") == [None] * 4


def test_boolean(spark):
    assert one(spark, c.safe_boolean, "true", "T", "1", " Sí ", "s") == [True] * 5
    assert one(spark, c.safe_boolean, "FALSE", "f", "0", "No", "n") == [False] * 5
    assert one(spark, c.safe_boolean, "quizás", "", None) == [None] * 3


def test_decimal(spark):
    assert one(spark, c.safe_decimal, "0,87", "87%", "87,5 %", "-0.10") == [
        Decimal("0.870000"), Decimal("0.870000"), Decimal("0.875000"), Decimal("-0.100000"),
    ]
    assert one(spark, c.safe_decimal, "", "%", "a", None) == [None] * 4


def test_sql_functions_agree(spark):
    c.register(spark)
    values = ["  a  b ", "7", "0,5", "50%", "Sí", "2026-03-15T10:00:00Z", "5/3/2026 9:00:00", "5/3/2026", "31/02/2026", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for name, (function, _) in c.SQL_FUNCTIONS.items():
        assert df.selectExpr(f"{name}(v) x").collect() == df.select(function("v").alias("x")).collect(), name


@settings(max_examples=3, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=25), min_size=40, max_size=60))
def test_never_raises_and_text_is_idempotent(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    df.select(*[f("v").alias(n) for n, (f, _) in c.SQL_FUNCTIONS.items()]).collect()
    once = df.select(c.clean_text("v").alias("v"))
    assert once.collect() == once.select(c.clean_text("v").alias("v")).collect()


@pytest.mark.parametrize("text", ["1/1/2024 25:00:00", "2024/13/01 00:00:00", "2024-01-01T99:00"])
def test_impossible_times(spark, text):
    assert one(spark, c.safe_timestamp, text) == [None]

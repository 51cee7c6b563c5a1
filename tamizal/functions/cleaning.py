"""Tolerant text conversions: a value that cannot be read becomes NULL and never raises.

Every function takes and returns a ``Column`` made of built-in expressions, so Catalyst sees
through it. ``register`` offers the same functions to SQL text.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of a boolean, after lower-casing and accent removal.
TRUE_WORDS = ["true", "t", "1", "si", "s"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]



def _plain_letters() -> dict[str, str]:
    """Letters that Unicode takes apart into a plain letter and marks, with the plain letter."""
    found = {}
    for code in range(0xC0, 0x2000):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and base.isalpha() and all(unicodedata.combining(m) for m in marks):
            found[chr(code)] = base
    return found


_PLAIN_LETTERS = _plain_letters()
ACCENTED, PLAIN = "".join(_PLAIN_LETTERS), "".join(_PLAIN_LETTERS.values())
COMBINING_MARKS = r"[\u0300-\u036f]"

DECIMAL = T.DecimalType(18, 6)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str, collapse_inner: bool = True) -> Column:
    """Trim; blank text becomes NULL. ``collapse_inner`` also squeezes inner runs of space."""
    text = F.trim(_col(value))
    if collapse_inner:
        text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.nullif(text, F.lit(""))


def strip_accents(value: Column | str) -> Column:
    decomposed = F.regexp_replace(_col(value), COMBINING_MARKS, "")
    return F.translate(decomposed, ACCENTED, PLAIN)


def safe_integer(value: Column | str) -> Column:
    """Whole numbers only: ``1.5`` is not an integer."""
    return F.trim(_col(value)).try_cast("bigint")


# year first, with dashes or slashes, and a time of day or none
YEAR_FIRST = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?=$|[T ]\d{1,2}:)"
DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
CLOCK = r" \d{1,2}:\d{1,2}:\d{1,2}$"


def _year_first(text: Column) -> Column:
    canonical = F.regexp_replace(text, YEAR_FIRST, "$1-$2-$3")
    return F.when(text.rlike(YEAR_FIRST), canonical.try_cast("timestamp_ntz"))


def _day_first(text: Column, rest: str, kind: str) -> Column:
    """Rewritten year first and cast: no session time zone takes part."""
    return F.when(text.rlike(DAY_FIRST + rest), F.regexp_replace(text, DAY_FIRST, "$3-$2-$1").try_cast(kind))


def safe_timestamp(value: Column | str) -> Column:
    """Year first or ``day/month/year``; the wall clock is kept, a zone suffix is ignored."""
    text = F.trim(_col(value))
    return F.coalesce(_year_first(text), _day_first(text, CLOCK, "timestamp_ntz"))


def safe_date(value: Column | str) -> Column:
    text = F.trim(_col(value))
    return F.coalesce(_year_first(text).cast("date"), _day_first(text, "$", "date"))


def safe_boolean(value: Column | str) -> Column:
    word = strip_accents(F.lower(F.trim(_col(value))))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def safe_decimal(value: Column | str) -> Column:
    """Decimal comma or point; a trailing percent sign divides by one hundred, exactly."""
    text = F.replace(F.trim(_col(value)), F.lit(","), F.lit("."))
    number = F.trim(F.replace(text, F.lit("%"), F.lit(""))).try_cast(DECIMAL)
    return F.when(F.endswith(text, F.lit("%")), (number / 100).cast(DECIMAL)).otherwise(
        text.try_cast(DECIMAL)
    )


# SQL name -> (function, result type)
SQL_FUNCTIONS = {
    "texto_limpio": (clean_text, "STRING"),
    "sin_acentos": (strip_accents, "STRING"),
    "entero_seguro": (safe_integer, "BIGINT"),
    "fecha_hora_segura": (safe_timestamp, "TIMESTAMP_NTZ"),
    "fecha_segura": (safe_date, "DATE"),
    "booleano_seguro": (safe_boolean, "BOOLEAN"),
    "decimal_seguro": (safe_decimal, "DECIMAL(18,6)"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the conversions as temporary SQL functions, inlined by the optimizer on use."""
    letters = f"translate(regexp_replace({{}}, r'{COMBINING_MARKS}', ''), '{ACCENTED}', '{PLAIN}')"
    word = letters.format("lower(trim(valor))")

    def listed(words):
        return ", ".join(f"'{w}'" for w in words)

    point = "replace(trim(valor), ',', '.')"
    year_first = (
        f"CASE WHEN trim(valor) RLIKE r'{YEAR_FIRST}' THEN "
        f"try_cast(regexp_replace(trim(valor), r'{YEAR_FIRST}', '$1-$2-$3') AS TIMESTAMP_NTZ) END"
    )

    def day_first(rest, kind):
        return (
            f"CASE WHEN trim(valor) RLIKE r'{DAY_FIRST + rest}' THEN "
            f"try_cast(regexp_replace(trim(valor), r'{DAY_FIRST}', '$3-$2-$1') AS {kind}) END"
        )

    bodies = {
        "texto_limpio": r"nullif(trim(regexp_replace(trim(valor), r'\s+', ' ')), '')",
        "sin_acentos": letters.format("valor"),
        "entero_seguro": "try_cast(trim(valor) AS BIGINT)",
        "fecha_hora_segura": f"coalesce({year_first}, {day_first(CLOCK, 'TIMESTAMP_NTZ')})",
        "fecha_segura": f"coalesce(CAST({year_first} AS DATE), {day_first('$', 'DATE')})",
        "booleano_seguro": f"CASE WHEN {word} IN ({listed(TRUE_WORDS)}) THEN true WHEN {word} IN ({listed(FALSE_WORDS)}) THEN false END",
        "decimal_seguro": f"CASE WHEN endswith({point}, '%') THEN CAST(try_cast(trim(replace({point}, '%', '')) AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6)) "
        f"ELSE try_cast({point} AS DECIMAL(18,6)) END",
    }
    for name, body in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(valor STRING) RETURNS {SQL_FUNCTIONS[name][1]} RETURN {body}"
        )
    return list(bodies)

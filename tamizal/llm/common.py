"""Helpers shared by the operators of this folder: tables, column names, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamizal.session import scratch_path

# White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"

ARROW_ROWS = 1000
ARROW_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> SparkSession:
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes, so that a worker holds few texts at once,
    or few more than one where texts are longer than that. The settings are the session's from here on."""
    for key, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{key}"
        if str(spark.conf.get(name, None)) != str(value):
            spark.conf.set(name, value)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written (ZSTD) to the folder all executors share, and read back.

    Later steps start from files: a lost executor costs a re-read, and the size is known to Spark.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SPREAD_ROWS = 500_000


def spread(df: DataFrame, key: str, times: int = 1) -> DataFrame:
    """``df`` dealt by ``key`` to so many tasks that each makes about ``SPREAD_ROWS`` rows when a row becomes ``times``.

    A small file is one task otherwise, however many rows it is expanded to. ``df`` is counted: a written one.
    """
    return df.repartition(max(1, -(-df.count() * times // SPREAD_ROWS)), key)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front while a column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def _evened(text: Column) -> Column:
    even = F.coalesce(text, F.lit(""))
    for other in BLANKS[1:]:
        even = F.replace(even, F.lit(other), F.lit(" "))
    return F.trim(even)


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for null, empty or blank texts."""
    bare = _evened(text)
    # a split at one plain character needs no regular expression; runs of blanks leave empty words
    parts = F.split(bare, " ")
    parts = F.when(F.contains(bare, F.lit("  ")), F.array_remove(parts, "")).otherwise(parts)
    return F.when(F.length(bare) > 0, parts).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """``size(words_of(text))`` without the array, unless there are runs of blanks."""
    bare = _evened(text)
    blanks = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(" "), F.lit("")))
    some = F.when(F.contains(bare, F.lit("  ")), F.size(words_of(text))).otherwise(blanks + 1)
    return F.when(F.length(bare) > 0, some).otherwise(F.lit(0)).cast("bigint")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links ``a``, ``b`` (bigint): ``node``, ``component_id``.

    ``component_id`` is the smallest node reachable. Alternating stars: every round joins the larger
    neighbours of a node to its smallest neighbour, then the smaller ones; the number of rounds is
    logarithmic. A node with very many links only costs a partial minimum and a join that adaptive
    execution can split. Self links and repeated links do no harm; no links, no rows.
    """
    links = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or state[0] == 0:
            return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component_id")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
            )
        seen = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours v > u of u go to the smallest neighbour of u
        large = links.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        # u is the larger end of each link now; its smaller ends go to the smallest of them
        large = written(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")
        links = written(
            small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small-star"
        )

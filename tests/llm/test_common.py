"""Helpers of the folder: batches bounded in rows and bytes."""

import pyarrow as pa

from tamizal.llm.common import bounded_batches


def test_batches_are_bounded_in_rows_and_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "b"])

    try:
        bounded_batches(spark, 50, 4 << 20)
        long = spark.range(60, numPartitions=1).selectExpr("repeat('x', 1000000) AS text").mapInArrow(sizes, "n bigint, b bigint").collect()
        short = spark.range(500, numPartitions=1).selectExpr("'x' AS text").mapInArrow(sizes, "n bigint, b bigint").collect()
    finally:
        bounded_batches(spark)
    assert sum(r.n for r in long) == 60 and max(r.b for r in long) < 7 << 20
    assert [r.n for r in short] == [50] * 10

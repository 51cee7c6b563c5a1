"""The training-data pipeline: five stages over ``documents``, each written and read by the next.

Documents that the quality rules reject go; of each group of near copies one stays; secrets are masked;
documents are drawn towards the target weights; what is left becomes piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamizal.llm.common import table, written
from tamizal.llm.mixing import mixing_stage
from tamizal.llm.quality_rules import quality_stage
from tamizal.llm.secret_scan import secret_stage
from tamizal.llm.sentence_pieces import piece_stage
from tamizal.llm.simhash_dedup import simhash_stage

STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("secret scans", secret_stage),
    ("mixing to target weights", mixing_stage),
    ("sentencepiece encoding", piece_stage),
]

# The pieces of a text and its fingerprint have no SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-stage-{number + 1}")
    return docs

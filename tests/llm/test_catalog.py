"""Every query of the folder over whole tables: against its SQL where there is one, else its shape."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

import corpus_pipeline  # noqa: E402
from compare import compare, connect  # noqa: E402

from tamizal.llm.catalog import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op3_page_text": ["page_id", "url", "text", "n_chars"],
    "op4_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_sentence_pieces": ["doc_id", "n_pieces", "ids_hash", "round_trip"],
    "op7_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_as_sql(spark, name):
    run, sql = QUERIES[name]
    assert compare(spark, connect(SF_DIR), name, run, sql, SF_DIR) is None


@pytest.mark.parametrize("name", list(COLUMNS))
def test_one_row_for_each(spark, name):
    out = QUERIES[name][0](spark, SF_DIR)
    assert out.columns == COLUMNS[name]
    assert out.count() == spark.read.parquet(f"{SF_DIR}/{'pages' if name.startswith('op3') else 'documents'}.parquet").count()


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_DIR).cache()
        assert 0 < docs.count() <= kept
        kept = docs.count()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ran = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, ran.collect())) == sorted(map(str, docs.collect()))

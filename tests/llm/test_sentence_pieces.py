import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tamizal.llm import sentence_pieces
from tamizal.llm.sentence_pieces import Pieces, decode_pieces, encode_pieces, piece_stage

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_same_as_the_library(library):
    rng = random.Random(5)
    texts = ["", " ", "  ", "▁", "▁ ▁a", " a", "a ", "x" * 300]
    texts += ["".join(rng.choice("abcdethion  \n\t.,'éü▁中😀\x00 01<s>/") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    model = Pieces(PATH)
    ids = [np.frombuffer(c, "<i4").tolist() for c in model.encode(texts)]
    assert ids == [library.encode(t) for t in texts]
    assert [model.decode(np.array(i, int)) for i in ids] == [library.decode(i) for i in ids]


def test_unigram_scores_by_brute_force():
    pieces = {"a": -1.0, "b": -1.2, "ab": -1.9, "ba": -2.5, "aab": -2.2, "bb": -3.0}
    model = Pieces.__new__(Pieces)
    model.setup({p: (i, s) for i, (p, s) in enumerate(pieces.items())}, list(range(256)), "unigram")
    words = sorted("".join(w) for n in range(1, 8) for w in itertools.product("ab", repeat=n))

    def best(word):
        if not word:
            return 0.0
        return max(pieces[word[:k]] + best(word[k:]) for k in range(1, 4) if word[:k] in pieces)

    for word, found in model.segment(words):
        assert "".join(found) == word and abs(sum(pieces[p] for p in found) - best(word)) < 1e-9


def test_frames(spark, docs, empty, library):
    clash = docs.withColumnsRenamed({"lang": "ids", "source": "decoded"})
    coded = encode_pieces(clash, PATH)
    for row in decode_pieces(coded, PATH).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert row.ids == library.encode(row.text or "") and row.decoded == (row.text or "")
    stage = piece_stage(spark, docs, "")
    assert stage.count() == docs.count() and stage.where("NOT round_trip").count() == 0
    assert piece_stage(spark, empty, "").count() == 0


def test_one_worker_encodes_and_reads_back(spark, docs):
    """A second Python worker per task, and the text on its way to it, is memory that the executors do not have."""
    stage = piece_stage(spark, docs, "")
    assert stage._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert stage.columns == ["doc_id", "lang", "source", "n_chars", "ids", "round_trip", "n_pieces"]
    marked = spark.createDataFrame([(1, "a▁b  c"), (2, None)], "doc_id bigint, text string")
    kept = encode_pieces(marked, PATH, agrees="same")
    assert kept.columns == ["doc_id", "text", "ids", "same"] and kept.where("same").count() == 2


def test_what_is_read_back_is_compared(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "t": ["ab", "", "cd"]})
    monkeypatch.setattr(Pieces, "decode", lambda self, ids: "ab" if len(ids) else "")
    (out,) = sentence_pieces._encode(PATH, "bpe", "t", "ids", "same")(iter([batch]))
    assert out.column("same").to_pylist() == [True, True, False] and out.schema.names == ["doc_id", "ids", "same"]

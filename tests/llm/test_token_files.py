import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tamizal.llm import simple8b
from tamizal.llm.token_files import UnitEncoder, encoder, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("high", [1, 300, 50_256, 1 << 59, (1 << 64) - 1])
def test_words_round_trip(high):
    rng = np.random.default_rng(1)
    for n in (0, 1, 1023, 1024, 1025, 7000):
        ids = rng.integers(0, high, n, dtype=np.uint64, endpoint=True)
        words, first = simple8b.encode(ids)
        assert (simple8b.decode(words) == ids).all()
        for block, at in enumerate(first[:-1].tolist()):  # a block is read by its offset alone
            own = simple8b.decode(words[at : first[block + 1]])
            assert (own == ids[block * simple8b.BLOCK : (block + 1) * simple8b.BLOCK]).all()


def test_units_give_the_ids_of_whole_texts(library):
    rng = random.Random(2)
    texts = ["", " ", "a  b", "a\n  b", "a \n b ", "<|endoftext|> x", "don't I'll", "　a  b", "\x1c a \x1c"]
    texts += ["".join(rng.choice(" \n\ta1.'sé \x1c\x85​中") for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    coded = UnitEncoder(PATH).encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library(t) for t in texts]


@pytest.mark.parametrize("file_ids", [1 << 25, 500])
def test_files_hold_every_document_in_order(spark, docs, library, tmp_path, file_ids):
    folder = f"file://{tmp_path}/ids"
    manifest = write_token_files(docs, folder, PATH, file_ids=file_ids)
    rows = sorted(read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    start = 0
    for row, (known, doc_id, text) in zip(rows, want, strict=True):
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert (row.doc_id, row.start, ids) == (doc_id if known else None, start, [*library(text), 2])
        start += len(ids)


def test_no_rows(spark, empty, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert read_token_files(write_token_files(empty, folder, PATH), folder).count() == 0


def test_added_tokens_in_a_text_are_as_the_library_has_them():
    plain = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|>", "one two<|endoftext|>three  four", "a <|endoftext|> b\n <|endoftext|>", "<|endoftext| > a", "one two"]
    coded = encoder(PATH).encode(texts)  # the one that files are written with
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert np.frombuffer(coded[0], "<u4").tolist() == [50256]

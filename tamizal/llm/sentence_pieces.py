"""SentencePiece encoding and decoding with one forward pass over shared prefixes.

The distinct marked words of a batch are sorted, which lays them out as a trie in depth-first order. The
forward pass of a word goes on from the longest prefix that it shares with the word before; only the
characters after it are new. For every prefix the pass holds the last piece of its best segmentation:

* a unigram model: Viterbi, the piece with the highest sum of scores;
* a BPE model (the file at hand): scores are merge ranks, and the highest sum is not what merging gives.
  A segmentation is the result of merging exactly if each two neighbouring pieces are: merges inside them
  run in the order they would have alone, and no merge ever crosses a border. So of all pieces that end
  a prefix there is one that fits the last piece of the prefix before it, and that is the forward state.

Words are encoded once per worker as long as a bounded memo holds them; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, free_name, table
from tamizal.llm.memo import Memo

MARK = "▁"
UNKNOWN_PENALTY = 10.0

_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_models: dict[tuple[str, str], Pieces] = {}


class Pieces:
    """The pieces of a model file, and the ids of marked words."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.setup(
            {model.id_to_piece(i): (i, model.get_score(i)) for i in range(size) if i not in special},
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
            kind,
        )
        if any(MARK in p.lstrip(MARK) or (p[0] == MARK and p[1:2] == MARK and p.strip(MARK)) for p in self.ids):
            raise ValueError("pieces that go over the border of a word are not supported")
        self.bytes_of = np.empty(size, object)
        self.bytes_of[:] = b""
        for piece, i in self.ids.items():
            self.bytes_of[i] = piece.replace(MARK, " ").encode()
        for value, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([value])

    def setup(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], kind: str) -> None:
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids, self.kind = byte_ids, kind
        self.fits: dict[tuple[str, str], bool] = {}
        self.memo = Memo(150_000)

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none can be merged."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, left: str, right: str) -> bool:
        """Whether merging ``left`` and ``right`` as one text leaves exactly these two pieces."""
        key = left, right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 300_000:
                self.fits.clear()
            known = self.fits[key] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def _next_bpe(self, word: str, end: int, last: list[str]) -> str:
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            piece = word[start:end]
            if (piece in self.ids or end - start == 1) and self.fit(last[start], piece):
                return piece
        raise ValueError(f"no segmentation of {word[:end]!r}")

    def _next_best(self, word: str, end: int, last: list[str], totals: list[float]) -> str:
        best, chosen = None, ""
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            piece = word[start:end]
            score = self.scores.get(piece, self.unknown if end - start == 1 else None)
            if score is not None and (best is None or totals[start] + score > best):
                best, chosen = totals[start] + score, piece
        totals.append(best)
        return chosen

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Pieces of every word of the sorted list ``words``."""
        before, last, totals = "", [""], [0.0]
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], totals[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                last.append(
                    self._next_bpe(word, end, last) if self.kind == "bpe" else self._next_best(word, end, last, totals)
                )
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            before = word
            yield word, pieces[::-1]

    def _learn(self, words: set[str]) -> None:
        for word, pieces in self.segment(sorted(self.memo.missing(words))):
            ids: list[int] = []
            for piece in pieces:
                known = self.ids.get(piece)
                ids += [known] if known is not None else [self.byte_ids[b] for b in piece.encode()]
            self.memo.young[word] = np.array(ids, "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; none for an empty one."""
        marked = []
        for text in texts:
            if not text:
                marked.append([])
            elif "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
                marked.append(_UNIT.findall(MARK + text.replace(" ", MARK)))
            else:
                marked.append((MARK + text.replace(" ", f" {MARK}")).split(" "))
        self._learn(set().union(*marked))
        ids = self.memo.young.__getitem__
        out = [b"".join(map(ids, units)) for units in marked]
        self.memo.turn()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(self.bytes_of[ids].tolist()).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def pieces_of(path: str, kind: str) -> Pieces:
    if (path, kind) not in _models:
        _models[path, kind] = Pieces(path, kind)
    return _models[path, kind]


def _grouped(sizes: list[int], most: int = 1 << 21) -> Iterator[slice]:
    begin = size = 0
    for i, own in enumerate(sizes):
        size += own
        if size >= most or i == len(sizes) - 1:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0


def _encode(path: str, kind: str, text: str, ids: str, agrees: str | None = None):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path, kind)
        for batch in batches:
            # only the texts of one group are Python objects at a time
            for rows in _grouped(pc.utf8_length(batch.column(text)).to_pylist()):
                part = batch.slice(rows.start, rows.stop - rows.start)
                texts = part.column(text).to_pylist()
                coded = model.encode(texts)
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                made = {ids: pa.ListArray.from_arrays(pa.array(offsets), flat)}
                if agrees:
                    read = (model.decode(np.frombuffer(c, "<i4")) for c in coded)
                    made[agrees] = pa.array([r == t.replace(MARK, " ") for r, t in zip(read, texts)], pa.bool_())
                kept = [n for n in part.schema.names if n != text]
                yield pa.RecordBatch.from_arrays([*map(part.column, kept), *made.values()], names=[*kept, *made])

    return encode


def _decode(path: str, kind: str, ids: str, text: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path, kind)
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            at = column.offsets.to_numpy() - column.offsets[0].as_py()
            decoded = [model.decode(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, text]
            )

    return decode


def encode_pieces(
    docs: DataFrame, path: str, kind: str = "bpe", text: str = "text", ids: str = "ids", agrees: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``ids`` (array of int): piece ids of ``text``. No ids for a null or empty text.

    With ``agrees``, a boolean column of that name tells whether the ids decode to the text (the marker itself is
    read back as a blank); the worker that encodes also decodes. Without ``keep_text`` the text does not come back.
    Columns of ``docs`` that are named like new ones are replaced. Repeated rows are encoded alike.
    """
    bounded_batches(docs.sparkSession)
    made = {ids: "array<int>"} | ({agrees: "boolean"} if agrees else {})
    gone = {n.lower() for n in made} | (set() if keep_text else {text.lower()})
    kept = [c for c in docs.columns if c.lower() not in gone]
    work = free_name(docs, "piece_text")
    own = docs.select(*kept, F.coalesce(text, F.lit("")).alias(work))
    schema = docs.select(*kept, *[F.lit(None).cast(t).alias(n) for n, t in made.items()]).schema
    return own.mapInArrow(_encode(path, kind, work, ids, agrees), schema)


def decode_pieces(coded: DataFrame, path: str, kind: str = "bpe", ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with ``text``: what ``ids`` stand for, without the blank that encoding puts in front.

    Null ids give an empty text. A column of ``coded`` that is named ``text`` is replaced.
    """
    bounded_batches(coded.sparkSession)
    own = coded.select(*[c for c in coded.columns if c.lower() != text.lower()])
    own = own.withColumn(ids, F.coalesce(ids, F.array().cast("array<int>")))
    return own.mapInArrow(_decode(path, kind, ids, text), own.withColumn(text, F.lit(None).cast("string")).schema)


def _coded_and_read(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with ``ids``, ``round_trip`` (whether they decode to the text) and ``n_pieces``."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode_pieces(docs, path, agrees="round_trip", keep_text=False)
    return coded.withColumn("n_pieces", F.size("ids").cast("bigint"))


def op6_sentence_pieces(spark, sf_dir):
    coded = _coded_and_read(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("doc_id", "n_pieces", F.xxhash64("ids").alias("ids_hash"), "round_trip")


def piece_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as piece ids: their columns but for the text, ``ids``, ``n_pieces``, ``round_trip``."""
    return _coded_and_read(docs)

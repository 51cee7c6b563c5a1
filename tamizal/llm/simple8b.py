"""Simple-8b word-aligned coding of ids, and a file of coded ids with its documents.

A 64-bit word holds a selector in its upper 4 bits and as many ids, of one width, as fit in the other
60. Selector 15 is an escape: the next word is one id of more than 60 bits. Ids come in blocks of
``BLOCK``, each begins a new word, and the file lists where; within a block all words are decoded at
once, selector by selector.

File: ``MAGIC``, the words, then little-endian int64 tables: first word of each block, ids in each block,
``doc_id`` of each document, ids of each document; at the end the numbers of words, blocks and
documents, and ``MAGIC`` again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MAGIC = b"S8B-IDS1"
BLOCK = 1024
ESCAPE = 15
# Fixed values of the format: selector, ids in a word, bits of each.
SELECTORS = [
    (1, 60, 1), (2, 30, 2), (3, 20, 3), (4, 15, 4), (5, 12, 5), (6, 10, 6), (7, 8, 7),
    (8, 7, 8), (9, 6, 10), (10, 5, 12), (11, 4, 15), (12, 3, 20), (13, 2, 30), (14, 1, 60),
]
_COUNT = np.zeros(16, np.int64)
_COUNT[ESCAPE] = 1
for _s, _c, _b in SELECTORS:
    _COUNT[_s] = _c


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``ids`` (uint64), and the first word of each block."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(n)
    left = np.minimum(BLOCK - place % BLOCK, n - place)
    chosen = np.full(n, ESCAPE, np.int8)
    for selector, count, bits in reversed(SELECTORS):  # a later choice holds more ids
        fits = ids < (1 << bits)
        width = 1
        while width < count:  # all of ``count`` neighbours fit
            step = min(width, count - width)
            fits[:-step] &= fits[step:]
            fits[-step:] = False
            width += step
        chosen[fits & (left >= count)] = selector
    count = _COUNT[chosen]
    begins = np.zeros(n, bool)
    at = np.arange(0, n, BLOCK)
    end = np.minimum(at + BLOCK, n)
    while len(at):  # one step in every block
        begins[at] = True
        at = at + count[at]
        more = at < end
        at, end = at[more], end[more]
    first = np.flatnonzero(begins)
    selector = chosen[first]
    size = np.where(selector == ESCAPE, 2, 1)
    word_at = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[word_at] = selector.astype(np.uint64) << np.uint64(60)
    for s, c, b in SELECTORS:
        own = selector == s
        if own.any():
            where, start = word_at[own], first[own]
            for j in range(c):
                words[where] |= ids[start + j] << np.uint64(j * b)
    raw = selector == ESCAPE
    words[word_at[raw] + 1] = ids[first[raw]]
    return words, word_at[np.searchsorted(first, np.arange(0, n, BLOCK))]


def decode(words: np.ndarray) -> np.ndarray:
    """Ids of whole blocks of words."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    after = -1
    for place in np.flatnonzero(selector == ESCAPE).tolist():
        if place != after:  # else it is itself an id that stands after an escape
            after = place + 1
            raw[after] = True
    count = np.where(raw, 0, _COUNT[selector])
    at = np.cumsum(count) - count
    ids = np.empty(int(count.sum()), np.uint64)
    for s, c, b in SELECTORS:
        own = np.flatnonzero((selector == s) & ~raw)
        for j in range(c):
            ids[at[own] + j] = (words[own] >> np.uint64(j * b)) & np.uint64((1 << b) - 1)
    escapes = np.flatnonzero(raw)
    ids[at[escapes - 1]] = words[escapes]
    return ids


class Writer:
    """Appends documents to an open binary stream; of a document it holds its id and its number of ids."""

    def __init__(self, stream, buffered: int = BLOCK << 8):
        self.stream, self.buffered = stream, buffered
        self.waiting: list[np.ndarray] = []
        self.held = self.words = self.ids = self.docs = 0
        self.blocks: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.doc_ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        stream.write(MAGIC)

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents one after another: ``counts`` ids each of ``ids``."""
        self.doc_ids.append(np.array(doc_ids, np.int64))
        self.counts.append(np.array(counts, np.int64))
        self.docs += len(counts)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.buffered:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        held = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint64)
        words, first = encode(held[:n].astype(np.uint64))
        self.stream.write(words.astype("<u8").tobytes())
        self.blocks.append(first + self.words)
        self.sizes.append(np.minimum(BLOCK, n - np.arange(0, n, BLOCK)))
        self.words += len(words)
        self.waiting, self.held = [held[n:]], len(held) - n

    def close(self) -> None:
        self._flush(self.held)
        tables = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (self.blocks, self.sizes, self.doc_ids, self.counts)]
        for values in [*tables, np.array([self.words, len(tables[0]), self.docs])]:
            self.stream.write(values.astype("<i8").tobytes())
        self.stream.write(MAGIC)
        self.stream.close()


def read(source, blocks_at_once: int = 256) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, ids of the file before it, ids) of a random-access file, holding a few blocks at once."""
    size = source.size()
    source.seek(size - 32)
    tail = source.read(32)
    source.seek(0)
    if tail[24:] != MAGIC or source.read(8) != MAGIC:
        raise ValueError("not a file of coded ids, or not a whole one")
    n_words, n_blocks, n_docs = np.frombuffer(tail[:24], "<i8").tolist()
    source.seek(8 + 8 * n_words)
    tables = np.frombuffer(source.read(8 * (2 * n_blocks + 2 * n_docs)), "<i8")
    first, doc_ids, counts = tables[:n_blocks], tables[2 * n_blocks : 2 * n_blocks + n_docs], tables[2 * n_blocks + n_docs :]
    edges = np.append(first, n_words)
    held, block, start = np.zeros(0, np.uint64), 0, 0
    for doc_id, count in zip(doc_ids.tolist(), counts.tolist()):
        parts, have = [held], len(held)
        while have < count:
            upto = min(block + blocks_at_once, n_blocks)
            source.seek(8 + 8 * int(edges[block]))
            more = decode(np.frombuffer(source.read(8 * int(edges[upto] - edges[block])), "<u8"))
            block, have = upto, have + len(more)
            parts.append(more)
        held = np.concatenate(parts) if len(parts) > 1 else held
        yield doc_id, start, held[:count]
        held, start = held[count:], start + count

"""Words and polynomial (Rabin-Karp) hashes over Arrow text columns, with numpy.

All arithmetic is modulo 2**64. A hash of any run of words comes from two prefix sums, so windows
of every length cost the same. Texts are taken in chunks of a few megabytes; one text longer than a
chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
HASHED_BYTES = 1 << 20

# Odd multipliers, so that each has an inverse modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
SEED_WORDS = 0xC2B2AE3D27D4EB4F
SEED_RUNS = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


class Powers:
    """``base ** i`` and its inverse for as many ``i`` as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            factor = np.uint64(pow(self.base, size, 1 << 64)), np.uint64(pow(self.inverse, size, 1 << 64))
            self.up = np.concatenate([self.up, self.up * factor[0]])
            self.down = np.concatenate([self.down, self.down * factor[1]])
        return self.up[:n], self.down[:n]


_BYTES, _WORDS, _RUNS = Powers(BYTE_BASE), Powers(SEED_WORDS), Powers(SEED_RUNS)


def prefix(values: np.ndarray, powers: Powers) -> np.ndarray:
    up, _ = powers.upto(max(len(values), 1))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def between(sums: np.ndarray, first: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of ``values[first:end]`` that do not depend on where they stand."""
    _, down = powers.upto(len(sums))
    return mixed((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


@dataclass
class Chunk:
    """Texts ``rows`` of a batch: bytes, and words by their places in the bytes."""

    rows: range
    data: np.ndarray
    bounds: np.ndarray  # bytes of text i: bounds[i] to bounds[i + 1]
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray  # words of text i: firsts[i] to firsts[i + 1]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word's bytes."""
        out = np.empty(len(self.starts), np.uint64)
        done = 0
        while done < len(out):
            base = self.starts[done]
            last = max(done + 1, int(np.searchsorted(self.ends, base + HASHED_BYTES, "right")))
            piece = self.data[base : self.ends[last - 1]].astype(np.uint64) + np.uint64(1)
            sums = prefix(piece, _BYTES)
            out[done:last] = between(sums, self.starts[done:last] - base, self.ends[done:last] - base, _BYTES)
            done = last
        return out

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Words (those that ``keep`` marks) of each text joined by one blank: bytes and their bounds."""
        starts, ends = (self.starts, self.ends) if keep is None else (self.starts[keep], self.ends[keep])
        of = np.searchsorted(self.bounds, starts, "right") - 1  # with empty texts, the last that begins here
        mark = np.zeros(len(self.data) + 2, np.int8)
        mark[starts] = 1
        mark[np.minimum(ends + 1, self.bounds[of + 1])] -= 1  # no two words have the same place here
        inside = np.cumsum(mark[: len(self.data)], dtype=np.int8) > 0
        count = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(inside, out=count[1:])
        text = np.where(_BLANK[self.data], np.uint8(0x20), self.data)[inside]
        lows, highs = count[self.bounds[:-1]], count[self.bounds[1:]]
        # the blank after a text's last word
        extra = (highs > lows) & (text[np.maximum(highs - 1, 0)] == 0x20) if len(text) else np.zeros(len(lows), bool)
        if extra.any():
            stay = np.ones(len(text), bool)
            stay[highs[extra] - 1] = False
            text = text[stay]
        sizes = highs - lows - extra
        return text, np.concatenate([[0], np.cumsum(sizes)])


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """``texts`` (no nulls) in chunks."""
    size = len(texts)
    if size == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + size + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < size:
        end = max(row + 1, int(np.searchsorted(places, places[row] + CHUNK_BYTES, "right")) - 1)
        yield _chunk(range(row, end), raw[places[row] : places[end]], places[row : end + 1] - places[row])
        row = end


def _chunk(rows: range, data: np.ndarray, bounds: np.ndarray) -> Chunk:
    word = ~_BLANK[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = bounds[:-1][bounds[:-1] < len(data)]
    before[inner] = False  # a word never goes over the end of a text
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return Chunk(rows, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def texts_of(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A string array of the bytes between ``bounds``, without a copy for each."""
    return pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())
    ).cast(pa.string())


def word_sums(hashes: np.ndarray) -> np.ndarray:
    return prefix(hashes, _WORDS)


def run_sums(hashes: np.ndarray) -> np.ndarray:
    return prefix(hashes, _RUNS)


def word_runs(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return between(sums, first, end, _WORDS)


def word_runs_again(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A second hash of the same words, by another multiplier."""
    return between(sums, first, end, _RUNS)

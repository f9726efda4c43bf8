"""Words of whole texts and their 64-bit hashes, computed on the UTF-8 bytes of an Arrow column.

Both word definitions used here are decided byte by byte (every byte from 0x80 on belongs to a word), so a batch of
texts is one byte array with marked document borders, and nothing is done per word in Python. A word's hash is a
polynomial in its bytes modulo 2**64, taken from one running sum, so any part of a word can be hashed as well. Work
goes in slices of a few megabytes; a text or a word longer than a slice is hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21  # texts handled at once
PIECE_BYTES = 1 << 19  # bytes hashed at once

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
GRAM_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all the others."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed, well-spread 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE_VALUES = numbers(256, 17)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_codes = np.arange(256)
#: After lower-casing: digits, a-z and everything beyond ASCII.
LETTERS = ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x61) & (_codes <= 0x7A)) | (_codes >= 0x80)
#: Everything but the blank and 0x09 to 0x0D.
UNSPACED = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    ones = np.ones(1, dtype=U64)
    up = np.concatenate([ones, np.cumprod(np.full(PIECE_BYTES, BASE & (2**64 - 1), dtype=U64))])
    down = np.concatenate([ones, np.cumprod(np.full(PIECE_BYTES, INVERSE, dtype=U64))])
    return up, down


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the place where each text begins (one more than there are texts). Null is
    empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


@dataclass
class Words:
    """Words of the texts ``first`` to ``last`` of a batch: where each begins and ends in ``data``, and its text's
    number within the slice."""

    first: int
    last: int
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.last - self.first).astype(np.int64)

    @property
    def borders(self) -> np.ndarray:
        """Number of the first word of each text, and the number of words."""
        return np.concatenate([[0], np.cumsum(self.per_text)])

    def hashes(self) -> np.ndarray:
        return hash_parts(self.data, self.begin, self.end)

    def string(self, word: int) -> str:
        return self.data[self.begin[word] : self.end[word]].tobytes().decode("utf-8", "replace")


def word_slices(column, member: np.ndarray, slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a column, slice by slice; ``member`` tells which bytes belong to words."""
    data, offsets = text_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_bytes, side="right")) - 1)
        last = min(last, n)
        low, high = int(offsets[first]), int(offsets[last])
        part = LOWER[data[low:high]]
        borders = offsets[first : last + 1] - low
        inside = member[part]
        before = np.empty_like(inside)
        before[1:], before[:1] = inside[:-1], False
        before[borders[:-1][borders[:-1] < len(part)]] = False
        after = np.empty_like(inside)
        after[:-1], after[-1:] = inside[1:], False
        after[borders[1:][borders[1:] > 0] - 1] = False
        begin = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        yield Words(first, last, part, begin, end, np.searchsorted(borders[1:], begin, side="right"))
        first = last


def hash_parts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each ``begin`` (ascending) to its ``end``."""
    up, down = powers()
    out = np.empty(len(begin), dtype=U64)
    i = 0
    while i < len(begin):
        start = int(begin[i])
        j = max(i + 1, int(np.searchsorted(end, start + PIECE_BYTES, side="right")))
        if end[i] - start > PIECE_BYTES:  # one long word, piece by piece
            total, scale, step = 0, 1, pow(BASE, PIECE_BYTES, 1 << 64)
            for at in range(start, int(end[i]), PIECE_BYTES):
                piece = BYTE_VALUES[data[at : min(at + PIECE_BYTES, int(end[i]))]]
                total += scale * int((piece * up[: len(piece)]).sum(dtype=U64))
                scale = scale * step % (1 << 64)
            out[i] = total % (1 << 64)
            j = i + 1
        else:
            values = BYTE_VALUES[data[start : int(end[j - 1])]]
            values *= up[: len(values)]
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
            out[i:j] = (sums[end[i:j] - start] - sums[begin[i:j] - start]) * down[begin[i:j] - start]
        i = j
    return mix(out + (end - begin).astype(U64) * U64(GRAM_BASE))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, borders of texts ignored; the caller keeps the runs within one text."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=U64)
    total = np.full(count, n, dtype=U64)
    for j, factor in enumerate(numbers(n, GRAM_BASE & 0xFFFFFFFF) | U64(1)):
        total += hashes[j : j + count] * factor
    return mix(total)


def within(text: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words from each word on lie in one text."""
    count = max(0, len(text) - n + 1)
    return text[:count] == text[n - 1 : n - 1 + count]

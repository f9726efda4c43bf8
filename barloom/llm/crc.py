"""CRC-32 of many words at once, over the bytes of a batch."""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes of a word that are taken together with those of all other words; the rest of a longer word follows alone.
TOGETHER = 64


def _table() -> np.ndarray:
    """The checksum's remainders of all byte values, from its polynomial."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value


TABLE = _table()


def crc32_extend(crc: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The checksum of each text that had ``crc`` before, with the bytes of ``data`` from ``begin`` to ``end`` appended.
    A checksum of nothing is 0. Texts are taken place by place, shorter ones leave early."""
    length = end - begin
    order = np.argsort(-length, kind="stable")
    at, ordered = begin[order], length[order]
    state = ~crc[order].astype(np.uint32)
    for place in range(min(TOGETHER, int(ordered[0]) if len(ordered) else 0)):
        n = int(np.searchsorted(-ordered, -place, side="left"))  # texts with more than ``place`` bytes
        state[:n] = TABLE[(state[:n] ^ data[at[:n] + place]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    state = ~state
    for i in range(int(np.searchsorted(-ordered, -TOGETHER, side="left"))):
        rest = data[at[i] + TOGETHER : at[i] + ordered[i]].tobytes()
        state[i] = zlib.crc32(rest, int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def crc32_of_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return crc32_extend(np.zeros(len(begin), dtype=np.uint32), data, begin, end)


def crc32_with_blank(crc: np.ndarray) -> np.ndarray:
    """The checksum after one more byte, a blank."""
    state = ~crc
    return ~(TABLE[(state ^ np.uint32(0x20)) & np.uint32(255)] ^ (state >> np.uint32(8)))

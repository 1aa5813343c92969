"""Vectorised word hashes of UTF-8 texts (numpy, inside Spark tasks).

A word's hash is a polynomial over its bytes modulo 2**64, read off one running sum,
then mixed. All arithmetic wraps on purpose.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes hashed at a time; working arrays hold about 40 bytes for each.
SEGMENT = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    byte = np.arange(256, dtype=np.uint64)
    folded = byte.copy()
    folded[65:91] += np.uint64(32)  # A-Z only
    codes = mix((folded + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    blank = np.zeros(256, dtype=bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    powers = np.full(SEGMENT + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    inverse = np.full(SEGMENT + 1, _BASE_INV, dtype=np.uint64)
    inverse[0] = 1
    return codes, blank, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


class Words:
    """Word starts (byte offsets into ``data``), ends and a way to hash byte spans."""

    def __init__(self, data: np.ndarray):
        codes, blank, powers, self._inverse = _tables()
        word = ~blank[data]
        edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes[data] * powers[: len(data)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts]
                   + (ends - starts).astype(np.uint64))


def _segments(data: bytes) -> Iterator[tuple[int, int]]:
    """Cuts of at most SEGMENT bytes, at blanks where there is one."""
    at = 0
    while len(data) - at >= SEGMENT:
        cut = max(data.rfind(b, at, at + SEGMENT) for b in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r"))
        if cut <= at:  # one word longer than a segment
            cut = next((i for i in range(at + SEGMENT, len(data)) if data[i] in b" \t\n\x0b\x0c\r"), len(data))
            yield at, cut
            at = cut
            continue
        yield at, cut
        at = cut
    if at < len(data):
        yield at, len(data)


def _long_word(data: bytes) -> np.ndarray:
    """Hash of a single word longer than a segment, folded piece by piece."""
    total = np.zeros(1, dtype=np.uint64)
    for at in range(0, len(data), SEGMENT):
        piece = np.frombuffer(data[at:at + SEGMENT], dtype=np.uint8)
        codes, _, powers, _ = _tables()
        total = mix(total + (codes[piece] * powers[: len(piece)]).sum(dtype=np.uint64))
    return total


def text_word_hashes(data: bytes) -> np.ndarray:
    """uint64 hashes of the words of one text, in order; memory beyond the result is a
    few segments, whatever the text's length."""
    parts = []
    for at, to in _segments(data):
        piece = data[at:to]
        if len(piece) >= SEGMENT:
            piece = piece.strip(b" \t\n\x0b\x0c\r")
            if len(piece) >= SEGMENT:
                parts.append(_long_word(piece))
                continue
        w = Words(np.frombuffer(piece, dtype=np.uint8))
        parts.append(w.hashes(w.starts, w.ends))
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def batched_word_hashes(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, word hashes) of every text, in order; short texts share numpy calls."""
    group: list[int] = []
    size = 0

    def flush() -> Iterator[tuple[int, np.ndarray]]:
        data = b"\n".join(texts[i] for i in group)
        w = Words(np.frombuffer(data, dtype=np.uint8)) if data else None
        hashes = w.hashes(w.starts, w.ends) if w else np.empty(0, dtype=np.uint64)
        bounds = np.cumsum([0] + [len(texts[i]) + 1 for i in group])
        cuts = np.searchsorted(w.starts, bounds) if w else np.zeros(len(group) + 1, dtype=np.int64)
        for k, i in enumerate(group):
            yield i, hashes[cuts[k]:cuts[k + 1]]

    for i, text in enumerate(texts):
        length = len(text) if text is not None else 0
        if size + length + 1 > SEGMENT and group:
            yield from flush()
            group, size = [], 0
        if text is None:
            texts[i] = b""
        if length >= SEGMENT:
            yield i, text_word_hashes(text)
            continue
        group.append(i)
        size += length + 1
    if group:
        yield from flush()


_WIDTH_FACTORS = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) | 1 for k in range(64)], dtype=np.uint64)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-word windows; the whole sequence as one where it is shorter."""
    if len(words) == 0:
        return words
    if len(words) < width:
        total = (words * _WIDTH_FACTORS[: len(words)]).sum(dtype=np.uint64, keepdims=True)
        return mix(total + np.uint64(len(words)))
    total = words[: len(words) - width + 1] * _WIDTH_FACTORS[0]
    for k in range(1, width):
        total = total + words[k: len(words) - width + 1 + k] * _WIDTH_FACTORS[k]
    return mix(total)


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    if len(x) < 2:
        return x
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))]

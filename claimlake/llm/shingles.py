"""Hashes of words and word shingles of whole texts, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from . import common

WIDTH = 5
#: Text bytes hashed at a time (a longer document is taken whole); a worker's peak is some 40 bytes for each of them.
PIECE = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240601).integers(1, (1 << 63) - 1, size=256, dtype=np.int64).astype(np.uint64) * _U(2) + _U(1)
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n or more powers of the base and of its inverse modulo 2**64; those of a text over 2 * PIECE are not kept."""
    global _powers, _inverse
    if len(_powers) >= n:
        return _powers, _inverse
    n = max(n, 1 << 16)
    powers, inverse = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers, out=powers), np.cumprod(inverse, out=inverse)
    if n <= 2 * PIECE:
        _powers, _inverse = powers, inverse
    return powers, inverse


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64 bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _hash_words(plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of each word of bytes whose separators are spaces."""
    inside = plain != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    bounds = np.concatenate([[0] if len(plain) and inside[0] else [], edge, [len(plain)] if len(plain) and inside[-1] else []]).astype(np.int64)
    starts, ends = bounds[0::2], bounds[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    powers, inverse = _tables(len(plain))
    total = np.zeros(len(plain) + 1, dtype=np.uint64)
    np.multiply(_BYTES[plain], powers[: len(plain)], out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none without words."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append(text or b"")
        size += len(group[-1]) + 1
        if size >= PIECE:
            yield from _group_sets(group, width)
            group, size = [], 0
    if group:
        yield from _group_sets(group, width)


def _group_sets(group: list[bytes], width: int) -> Iterator[np.ndarray]:
    plain = np.frombuffer(b" ".join(group).translate(common.SPACE_WORDS), dtype=np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in group])
    starts, words = _hash_words(plain)
    firsts = np.searchsorted(starts, begins)
    rolled = words[: max(0, len(words) - width + 1)].copy()
    for k in range(1, width):
        rolled = rolled * _U(0xD6E8FEB86659FD93) + words[k : len(words) - width + 1 + k] if len(rolled) else rolled
    rolled = mix(rolled)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= width:
            one = np.sort(rolled[a : b - width + 1])
            yield one[np.concatenate([[True], one[1:] != one[:-1]])]
        elif b > a:
            short = np.array([b - a], dtype=np.uint64)
            for k in range(a, b):
                short = short * _U(0xD6E8FEB86659FD93) + words[k : k + 1]
            yield mix(short ^ _U(0x5851F42D4C957F2D))
        else:
            yield np.zeros(0, dtype=np.uint64)


def digest(hashes: np.ndarray) -> int:
    """A 64-bit digest of a set, as a signed number."""
    total = np.add.reduce(mix(hashes ^ _U(0xA0761D6478BD642F)), keepdims=True) + np.array([len(hashes)], dtype=np.uint64) * _U(0xE7037ED1A0B428DB)
    return int(mix(total).view(np.int64)[0])

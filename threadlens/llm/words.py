"""Vectorised hashes of words and of runs of words.

A word is a run of bytes outside space, tab, LF, VT, FF and CR. Its hash is a
polynomial over its bytes modulo 2**64, mixed; two different words collide with a
chance of about 2**-64. The hashes depend on the bytes alone, so every executor
computes the same ones.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 1 << 18


@lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)
    return series(_BASE), series(_BASE_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_piece(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a piece, and where in it each word starts."""
    data = np.frombuffer(piece, np.uint8)
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_IS_SPACE[data]
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    size = 1 << max(16, len(data).bit_length())
    up, down = powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    return mix(value ^ ((end - start).astype(np.uint64) << np.uint64(48))), start


def bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a text starts and ends, in bytes."""
    inside = np.pad((~_IS_SPACE[np.frombuffer(text, np.uint8)]).astype(np.int8), 1)
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def hash_words(text: bytes) -> np.ndarray:
    """One uint64 for each word of one text, in order; bounded work space unless a
    single word is longer than the step."""
    if len(text) <= _STEP:
        return _hash_piece(text)[0]
    parts, at = [], 0
    while at < len(text):
        end = min(at + _STEP, len(text))
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        parts.append(_hash_piece(text[at:end])[0])
        at = end
    return np.concatenate(parts)


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of many texts in one array, and the offsets of each text in it."""
    parts, counts, group, held = [], [], [], 0

    def flush() -> None:
        if len(group) == 1:
            parts.append(hash_words(group[0]))
            counts.append(np.array([len(parts[-1])]))
        elif group:
            value, start = _hash_piece(b" ".join(group))
            ends = np.cumsum([len(text) + 1 for text in group])
            parts.append(value)
            counts.append(np.diff(np.searchsorted(start, ends), prepend=0))
        group.clear()

    for text in texts:
        if held + len(text) > _STEP:
            flush()
            held = 0
        group.append(text)
        held += len(text) + 1
    flush()
    offsets = np.zeros(len(texts) + 1, np.int64)
    if parts:
        np.cumsum(np.concatenate(counts), out=offsets[1:])
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), offsets


def runs(words: np.ndarray, offsets: np.ndarray, width: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside each text.

    Returns hashes, the text each belongs to, and its first word's index in the text.
    With ``short``, a text of fewer words gives its whole sequence as one run.
    """
    count = np.diff(offsets)
    value = np.zeros(max(0, len(words) - width + 1), np.uint64)
    factor = [np.uint64(pow(_BASE, 2 * k + 3, 1 << 64)) for k in range(width)]
    for k in range(width):
        value += words[k:len(words) - width + 1 + k] * factor[k]
    value = mix(value + np.uint64(width))
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(words)) - offsets[:-1][owner]
    fits = (place + width <= count[owner])[:len(value)]
    value, at = value[fits], np.flatnonzero(fits)
    owner_of, place_of = owner[at], place[at]
    if short:
        few = np.flatnonzero((count > 0) & (count < width))
        if len(few):
            extra = np.zeros(len(few), np.uint64)
            for k in range(width - 1):
                has = count[few] > k
                extra[has] += words[offsets[few[has]] + k] * factor[k]
            extra = mix(extra + count[few].astype(np.uint64))
            value, owner_of = np.concatenate([value, extra]), np.concatenate([owner_of, few])
            place_of = np.concatenate([place_of, np.zeros(len(few), np.int64)])
            order = np.argsort(owner_of, kind="stable")
            value, owner_of, place_of = value[order], owner_of[order], place_of[order]
    return value, owner_of, place_of


def distinct(value: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text in ascending order, and the offsets of each text.
    ``owner`` ascends; texts are sorted one by one, which is faster than all at once."""
    cut = np.searchsorted(owner, np.arange(texts + 1))
    value = value.copy()
    for a, b in zip(cut[:-1], cut[1:]):
        value[a:b].sort()
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    total = np.concatenate([[0], np.cumsum(keep)])
    return value[keep], total[cut]

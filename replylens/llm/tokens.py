"""Tokens of many texts as 64-bit hashes, made with numpy a slice of bytes at a time.

Classes of bytes decide what a token is: runs of bytes of one class, class 0 apart. Bytes of
characters beyond ASCII have the class of letters. A-Z is lower-cased. Hashes are polynomials of a
token's bytes, mixed; they depend on nothing else.
"""

from __future__ import annotations

import numpy as np

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _classes(word_only: bool) -> np.ndarray:
    classes = np.ones(256, np.uint8)
    for c in range(128):
        if c in SPACE:
            classes[c] = 0
        elif not word_only and not (chr(c).isalnum() or chr(c) == "_"):
            classes[c] = 2
    return classes


WORDS = _classes(True)
WORDS_AND_MARKS = _classes(False)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (a bijection of 64-bit numbers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * (out[filled - 1 : filled] * BASE)
        filled += step
    return out


def hash_bytes(data: bytes, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the tokens of `data`."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    kind = classes[raw]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate([[0], change])
    lengths = np.diff(np.concatenate([starts, [len(raw)]]))
    offsets = np.arange(len(raw)) - np.repeat(starts, lengths)
    terms = (LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[offsets]
    hashes = np.add.reduceat(terms, starts)
    real = kind[starts] != 0
    return starts[real], mix(hashes[real])


def _slices(data: bytes):
    """Parts of about SLICE bytes that end before white space."""
    start = 0
    while start < len(data):
        end = start + SLICE
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[start:end]
        start = end


def token_hashes(texts: list[str | None], classes: np.ndarray):
    """Yields (first, ends, hashes) for runs of texts: the tokens of text first + i end at ends[i]."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(encoded):
        first, size = at, 0
        while at < len(encoded) and (at == first or size + len(encoded[at]) <= SLICE):
            size += len(encoded[at]) + 1
            at += 1
        group = encoded[first:at]
        if len(group) == 1 and len(group[0]) > SLICE:
            hashes = np.concatenate([hash_bytes(part, classes)[1] for part in _slices(group[0])])
            yield first, np.array([len(hashes)]), hashes
        else:
            starts, hashes = hash_bytes(b" ".join(group), classes)
            edges = np.cumsum([len(g) + 1 for g in group])
            yield first, np.searchsorted(starts, edges), hashes

"""Vectorised words and word shingles of many texts at once, as 64-bit hashes.

A text is its UTF-8 bytes. A byte table gives each byte's lower-case form (A-Z only) and whether
it belongs to a word; bytes of non-ASCII characters always do, so a byte table expresses the two
word rules used here exactly. Every word gets a polynomial hash from one running sum over the
step's bytes: no Python object per word is made.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)
#: Shingles, and words at their offsets in a window, are weighed by powers of this odd number.
MIX = 0xD1342543DE82EF95

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _is_word(ranges: list[tuple[int, int]]) -> np.ndarray:
    t = np.ones(256, bool)
    for a, b in ranges:
        t[a:b + 1] = False
    return t


#: Words split at white space: ``[^\x20\x09-\x0D]+``.
SPACED = _is_word([(0x20, 0x20), (0x09, 0x0D)])
#: Words of letters and digits: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = _is_word([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        with np.errstate(over="ignore"):
            for name, base in (("_POW", _P), ("_INV", _P_INV)):
                a = np.full(max(n, 1 << 17), base, np.uint64)
                a[0] = 1
                globals()[name] = np.cumprod(a, dtype=np.uint64)
    return _POW, _INV


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the whole word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and a final end, first byte and end byte of
    each word relative to ``offsets[0]``) for the texts between consecutive offsets."""
    base = int(offsets[0])
    text = LOWER[data[base:int(offsets[-1])]]
    rel = (offsets - base).astype(np.int64)
    n = len(text)
    if not n:
        return (np.empty(0, np.uint64), np.zeros(len(rel), np.int64), np.empty(0, np.int64),
                np.empty(0, np.int64))
    inside = word_bytes[text]
    edge = np.empty(n, bool)
    edge[0], edge[1:] = True, ~inside[:-1]
    edge[rel[:-1][rel[:-1] < n]] = True          # a word never runs over into the next text
    starts = np.flatnonzero(inside & edge)
    edge[:-1], edge[-1] = ~inside[1:], True
    last = rel[1:][rel[1:] > 0] - 1
    edge[last] = True
    ends = np.flatnonzero(inside & edge) + 1
    power, inverse = _powers(n + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[text] * power[:n], out=run[1:])
        h = mix64((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, rel).astype(np.int64), starts, ends


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` consecutive words at each position that has so many left."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out, c = np.zeros(n, np.uint64), 1
        for k in range(size):
            c = c * MIX % (1 << 64)
            out += h[k:k + n] * np.uint64(c)
        return mix64(out)


def shingle_sets(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one text after the other, and where each text's
    begin (with a final end). A text of fewer words has its whole sequence as its only shingle;
    a text without words has none."""
    every, n = shingles(h, size), np.diff(first)
    whole = np.maximum(n - size + 1, 0)
    count = np.where((n > 0) & (n < size), 1, whole)
    at = np.concatenate(([0], np.cumsum(count)))
    flat = np.empty(int(at[-1]), np.uint64)
    for k in np.flatnonzero(count):
        x = flat[at[k]:at[k + 1]]
        if whole[k]:
            x[:] = every[first[k]:first[k] + whole[k]]
            x.sort()
        else:
            x[0] = mix64(shingles(h[first[k]:first[k + 1]], int(n[k])) + np.uint64(n[k]))[0]
    new = np.ones(len(flat), bool)
    if len(flat):
        new[1:] = flat[1:] != flat[:-1]
        new[at[:-1][count > 0]] = True
    return flat[new], np.concatenate(([0], np.cumsum(new)))[at]

"""Rolling hashes over symbols and the minimisers of windows.

Any two equal windows of `length` symbols hold the same k-grams, so they pick the same one by
smallest hash (ties: the leftmost): their minimiser. Two windows can therefore only be equal if
their minimisers are, which lets a corpus be searched by about 2 / (length - k + 2) of its k-grams,
losing nothing.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(h):
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


#: Random values of bytes for two independent hashes.
BYTES = [mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(s)) for s in (11, 0x7F4A7C15)]
BASES = (0xD1342543DE82EF95, 0xA0761D6478BD642F)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(n: int, base: int):
    """base^0 .. base^n modulo 2^64, and those of its inverse."""
    if (held := _POWERS.get(base)) is None or len(held[0]) <= n:
        m = max(1 << 16, 1 << int(n).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.empty(m + 1, dtype=_U)
            p[0], filled = 1, 1
            while filled <= m:  # doubling
                step = min(filled, m + 1 - filled)
                p[filled : filled + step] = p[:step] * _U(pow(b, filled, 1 << 64))
                filled += step
            out.append(p)
        held = _POWERS[base] = tuple(out)
    return held


_POWERS: dict[int, tuple] = {}


def sums(symbols, base: int):
    """Prefix sums of symbol * base^position, one longer than symbols."""
    p, _ = powers(len(symbols), base)
    out = np.zeros(len(symbols) + 1, dtype=_U)
    np.cumsum(symbols * p[: len(symbols)], out=out[1:])
    return out


def ranges(total, starts, ends, base: int):
    """Hashes of the symbols from starts to ends, from their prefix sums."""
    _, inverse = powers(len(total), base)
    return mix((total[ends] - total[starts]) * inverse[starts])


def windows(symbols, length: int, lane: int):
    """Hash of each run of `length` symbols."""
    n = len(symbols) - length + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    total = sums(symbols, BASES[lane])
    _, inverse = powers(len(total), BASES[lane])
    return mix((total[length:] - total[:n]) * inverse[:n])


def words(text: bytes):
    """(start, end) of each word in bytes."""
    b = np.frombuffer(text, dtype=np.uint8)
    inside = np.concatenate([[False], ~SPACE[b], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(text: bytes, starts, ends):
    b = np.frombuffer(text, dtype=np.uint8)
    return ranges(sums(BYTES[0][b], BASES[0]), starts, ends, BASES[0])


def minimisers(symbols, length: int, k: int):
    """For each window of `length` symbols, the position of its minimiser; and the k-grams' hashes."""
    grams = windows(symbols, k, 0)
    width = length - k + 1
    n = len(symbols) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), grams
    low, span = grams, 1
    while span * 2 <= width:  # minima of 2^i neighbours
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[width - span : width - span + n])
    where = np.flatnonzero(is_low(grams, low, width))  # the grams that any window picks
    value = grams[where]
    first = np.searchsorted(where, np.arange(n))
    at = where[first]
    wrong = np.flatnonzero(grams[at] != low)
    while len(wrong):  # another selected gram stands before this window's own
        first[wrong] += 1
        at[wrong] = where[first[wrong]]
        wrong = wrong[value[first[wrong]] != low[wrong]]
    return at, grams


def is_low(grams, low, width: int):
    """Marks the grams that are the minimum of any window: gram g is, if one of the windows over it has its value."""
    m = len(grams)
    pad = np.concatenate([np.zeros(width - 1, dtype=_U), low, np.zeros(width - 1, dtype=_U)])
    top, span = pad, 1
    while span * 2 <= width:
        top = np.maximum(top[:-span], top[span:])
        span *= 2
    best = np.maximum(top[:m], top[width - span : width - span + m])
    return best == grams

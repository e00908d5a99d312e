"""Vectorised hashes of words and of windows, over bytes laid out one document after the other.

All hashes are polynomials modulo 2^64 in a fixed odd base, read off prefix
sums and divided by the base's power at the start, so that a sequence hashes
alike wherever it stands; a finaliser then mixes the bits. Work goes in
stretches that fit a CPU cache, so memory stays bounded for any text.

Polynomials have known collisions, so they only choose candidates. What decides
is a digest: values are mixed in pairs, pairs of pairs and so on, with a key
that each run draws anew, and a sequence is the mix of the two largest blocks of
a power of two that cover it.
"""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STRETCH = 1 << 16
_SPAN = 1 << 20
_tables: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that are split at white space.
PLAIN = np.ones(256, bool)
PLAIN[[32, *range(9, 14)]] = False
#: Bytes of words made of letters, digits and whatever is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(_SPAN + 1, base, np.uint64)
            x[0] = 1
            _tables[name] = np.multiply.accumulate(x)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _sums(values: np.ndarray) -> np.ndarray:
    up, _ = _powers()
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


def _long(values: np.ndarray) -> int:
    total = 0
    for at in range(0, len(values), _SPAN):
        total += int(_sums(values[at : at + _SPAN])[-1]) * pow(_BASE, at, 1 << 64)
    return total % (1 << 64)


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair; starts ascend and spans may overlap."""
    _, down = _powers()
    out, i, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while i < n:
        lo = starts[i]
        z = int(np.searchsorted(starts, lo + _STRETCH, "left"))
        fits = np.flatnonzero(ends[i:z] - lo > _SPAN)
        z = i + int(fits[0]) if len(fits) else z
        if z == i:
            out[i] = _long(data[lo : ends[i]])
            i += 1
            continue
        s = _sums(data[lo : int(ends[i:z].max())])
        out[i:z] = (s[ends[i:z] - lo] - s[starts[i:z] - lo]) * down[starts[i:z] - lo]
        i = z
    return mix(out)


def word_bounds(data: np.ndarray, offsets: np.ndarray, of_word: np.ndarray = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each document (n + 1 offsets)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = of_word[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | fresh[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | fresh[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of each ``length`` consecutive values."""
    _, down = _powers()
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, _STRETCH):
        m = min(_STRETCH, n - at)
        s = _sums(values[at : at + m + length - 1])
        out[at : at + m] = (s[length : length + m] - s[:m]) * down[:m]
    return mix(out)


def sliding(f, values: np.ndarray, length: int) -> np.ndarray:
    """f (minimum or maximum) over each ``length`` consecutive values, by doubling, in stretches."""
    n = len(values) - length + 1
    if n <= 0:
        return values[:0]
    out = np.empty(n, values.dtype)
    for at in range(0, n, _STRETCH):
        m = min(_STRETCH, n - at)
        x, have = values[at : at + m + length - 1], 1
        while have * 2 <= length:
            x = f(x[:-have], x[have:])
            have *= 2
        rest = length - have
        out[at : at + m] = f(x[:m], x[rest : rest + m]) if rest else x[:m]
    return out


def within(offsets: np.ndarray, length: int, n: int) -> np.ndarray:
    """For each of the n - length + 1 windows over n values: it lies in one document."""
    m = n - length + 1
    if m <= 0:
        return np.zeros(0, bool)
    end = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(length, n + 1) <= end[:m]


def anchors(grams: np.ndarray, gram: int, window: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest gram hash in each window, and which grams are that for a wanted window.

    Equal windows have the same smallest gram at the same places, so a window
    that occurs twice has one that occurs twice. Ties all count. Smallest
    hashes crowd at the low end, so they are mixed again before they are
    returned; mix() the chosen grams alike.
    """
    span = window - gram + 1
    least = sliding(np.minimum, grams, span)
    if not len(least):
        return least, np.zeros(len(grams), bool)
    shown = np.where(wanted, least, np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, np.uint64), shown, np.zeros(span - 1, np.uint64)])
    chosen = sliding(np.maximum, padded, span) == grams
    return mix(least), chosen & (grams != 0)


def _joined(left: np.ndarray, right: np.ndarray, key: np.uint64) -> np.ndarray:
    return mix(mix(left ^ key) * np.uint64(_BASE) + right)


def digests(values: np.ndarray, length: int, key: int) -> np.ndarray:
    """Digest of each ``length`` consecutive values, in stretches."""
    n, key = len(values) - length + 1, np.uint64(key)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, _STRETCH):
        m = min(_STRETCH, n - at)
        h, have = mix(values[at : at + m + length - 1].astype(np.uint64) + key), 1
        while have * 2 <= length:
            h = _joined(h[:-have], h[have:], key)
            have *= 2
        out[at : at + m] = _joined(h[:m], h[length - have : length - have + m], key)
    return out


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int) -> np.ndarray:
    """Digest of the bytes of each word: of long ones by BLAKE2, of others in stretches."""
    size, out = ends - starts, np.zeros(len(starts), np.uint64)
    for k in np.flatnonzero(size > 15).tolist():
        word = data[starts[k] : ends[k]].tobytes()
        out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=key.to_bytes(8, "little")).digest(), "little")
    short, key = np.flatnonzero(size <= 15), np.uint64(key)
    begin, size = starts[short], size[short]
    level = np.frexp(size.astype(float))[1] - 1  # of the largest block in the word
    i, got = 0, np.zeros(len(short), np.uint64)
    while i < len(short):
        lo = begin[i]
        z = int(np.searchsorted(begin, lo + _STRETCH, "left"))
        h, have = mix(data[lo : lo + _STRETCH + 16].astype(np.uint64) + key), 1
        for k in range(4):
            at = i + np.flatnonzero(level[i:z] == k)
            first = begin[at] - lo
            got[at] = mix(_joined(h[first], h[first + size[at] - have], key) + size[at].astype(np.uint64))
            if len(h) <= have:
                break
            h = _joined(h[:-have], h[have:], key)
            have *= 2
        i = z
    out[short] = got
    return out


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and whether each occurs twice or more."""
    values, counts = np.unique(values, return_counts=True)
    return values, counts > 1


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of ``length`` that begins at one of ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.subtract.at(step, starts + length, 1)
    return np.cumsum(step[:n]) > 0

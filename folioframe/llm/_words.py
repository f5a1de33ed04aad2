"""Words of many texts as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time; the bases of the word and of the window hash.
CHUNK = 1 << 20
BASE, WINDOW_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit integers; one to one."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        table = np.empty((2, n), "u8")
        table[:, 0] = 1
        table[0, 1:], table[1, 1:] = BASE, inverse
        _powers[:] = np.multiply.accumulate(table, axis=1)
    return _powers[0], _powers[1]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word ([^\\x20\\x09-\\x0D]+) of the texts in order, and the position in texts of its text."""
    data = np.frombuffer(b" ".join([*texts, b""]), "u1")
    ends = np.cumsum([len(t) + 1 for t in texts])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    hashes, begins, start = [], [], 0
    while start < len(data):
        stop = min(len(data), start + CHUNK)
        if stop < len(data):  # up to white space
            tail = np.flatnonzero(blank[stop - 1 :])
            stop = stop + int(tail[0]) if len(tail) else len(data)
        b, gap = data[start:stop], blank[start:stop]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
        s, e = edges[::2], edges[1::2]
        power, inverse = _power_table(max(CHUNK + 1, stop - start + 1))
        sums = np.zeros(len(b) + 1, "u8")
        np.cumsum((b.astype("u8") + np.uint64(1)) * power[: len(b)], out=sums[1:])
        h = (sums[e] - sums[s]) * inverse[s]
        hashes.append(mixed(h ^ ((e - s).astype("u8") << np.uint64(40))))
        begins.append(s + start)
        start = stop
    if not hashes:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(begins), "right")


def prefix_hashes(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Before each byte, the hash of the run of bytes inside a word that ends there; 0 where there is none."""
    n = len(data)
    power, inverse = _power_table(n + 1)
    sums = np.zeros(n + 1, "u8")
    np.cumsum((data.astype("u8") + np.uint64(1)) * power[:n], out=sums[1:])
    start = np.zeros(n + 1, "i8")  # where the word before a byte begins
    start[1:] = np.where(inside, 0, np.arange(1, n + 1))
    np.maximum.accumulate(start, out=start)
    at = np.arange(n + 1)
    h = (sums - sums[start]) * inverse[start]
    return np.where(start == at, np.uint64(0), mixed(h ^ ((at - start).astype("u8") << np.uint64(40))))[:n]


def window_hashes(words: np.ndarray, text_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside a text, and the position in words of each one's first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    h = words[:n].copy()
    for i in range(1, size):
        h *= WINDOW_BASE
        h += words[i : n + i]
    at = np.flatnonzero(text_of[:n] == text_of[size - 1 :])
    return mixed(h[at]), at

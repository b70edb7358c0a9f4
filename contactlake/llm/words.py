"""Vectorised words and word hashes of many texts at once."""
from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
#: odd base of the polynomial word hash, and its inverse modulo 2**64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: odd base that joins word hashes to k-gram hashes
_JOIN = np.uint64(0xD1342543DE82EF95)
#: bytes hashed at once; a longer word is still hashed whole
BLOCK = 1 << 20
_powers: list[np.ndarray] = []


def byte_classes(is_word, lower: bool) -> np.ndarray:
    """256 entries: 0 for a separator byte, else the (lower-cased) byte."""
    out = np.zeros(256, np.uint8)
    for b in range(1, 256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        if is_word(c):
            out[b] = c
    return out


#: letters a-z (A-Z lower-cased), digits and everything beyond ASCII
ALNUM = byte_classes(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122, lower=True)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[:] = both
    return _powers[0], _powers[1]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``data[start:end]`` (ascending, apart from each other)."""
    out = np.empty(len(start), np.uint64)
    i, n = 0, len(start)
    while i < n:  # blocks of whole runs
        a = start[i]
        j = max(i + 1, int(np.searchsorted(end, a + BLOCK, "right")))
        b = end[j - 1]
        up, down = _pow(int(b - a) + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(data[a:b] * up[:b - a], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


class Words:
    """Words of a slice of texts: ``low`` (bytes, classes applied), ``start`` and ``end``
    byte positions, ``hash`` (64 bits of the word's bytes), ``doc`` (index of its text) and
    ``first`` (index of each text's first word; one more entry than texts)."""

    def __init__(self, texts: list[str], classes: np.ndarray = ALNUM):
        raw = [t.encode() for t in texts]
        joined = b"\0".join(raw) + b"\0"
        low = classes[np.frombuffer(joined, np.uint8)]
        word = low != 0
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if len(word) and word[0]:
            edge = np.concatenate(([0], edge))
        self.low, self.start, self.end = low, edge[0::2], edge[1::2]
        stops = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.searchsorted(self.start, stops)))
        self.doc = np.repeat(np.arange(len(raw)), np.diff(self.first))
        self.hash = run_hashes(low, self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.low[self.start[i]:self.end[i]].tobytes()

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-grams that begin at each word, and which lie in one text."""
        n = max(0, len(self.hash) - k + 1)
        g = np.zeros(n, np.uint64)
        for j in range(k):
            g = g * _JOIN + self.hash[j:j + n]
        return mix(g + np.uint64(k)), self.doc[:n] == self.doc[k - 1:k - 1 + n]

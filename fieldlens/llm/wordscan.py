"""Words of a batch of texts as numpy arrays: places and 64-bit hashes, without a Python loop per word.

A batch is encoded once to UTF-8. Words are runs of bytes that a 256-entry table marks as word
bytes (bytes of 128 and more belong to multi-byte characters, so a table never splits one). The
hash of a word is a polynomial in its bytes modulo 2**64, taken from running sums, so its cost does
not depend on the number of words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))

# Words of the contracts: everything between blanks and the ASCII controls tab to carriage return.
BLANK_SPLIT = np.ones(256, dtype=bool)
BLANK_SPLIT[[0x20, *range(0x09, 0x0E)]] = False

# Words without punctuation: ASCII letters and digits, and every character beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[128:] = True
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    ALNUM[_lo:_hi + 1] = True

_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _power(kind: str, n: int) -> np.ndarray:
    """1, b, b**2, ... modulo 2**64; grown by doubling and kept for the worker's next batch."""
    table = _powers[kind]
    base = _BASE if kind == "up" else _INVERSE
    while len(table) < n:
        table = np.concatenate([table, table * (table[-1:] * base)])
    _powers[kind] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words:
    """Words of a list of texts (null counts as empty).

    ``start`` and ``end`` are byte places in ``data``; ``doc`` is the text each word comes from;
    ``first`` has, for text d, the number of words before it (length: texts + 1).
    """

    def __init__(self, texts, table: np.ndarray = BLANK_SPLIT, lower: bool = False) -> None:
        """``lower``: A to Z count as a to z, other letters stay as they are."""
        raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        blob = b" ".join(raw)
        if lower:
            blob = blob.lower()
        self.data = np.frombuffer(blob, np.uint8)
        self.blob = blob
        sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
        ends = np.cumsum(sizes)
        inside = np.zeros(len(blob) + 2, dtype=np.int8)
        inside[1:-1] = table[self.data]
        if len(raw) > 1:
            inside[ends[:-1]] = 0
        step = np.diff(inside)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(raw)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        if not len(self):
            return np.zeros(0, U)
        total = np.zeros(n + 1, U)
        np.cumsum((self.data.astype(U) + U(1)) * _power("up", n), out=total[1:])
        value = (total[self.end] - total[self.start]) * _power("down", n)[self.start]
        return mix(value + (self.end - self.start).astype(U) * U(0xD6E8FEB86659FD93))

    def word(self, i: int) -> str:
        return self.blob[self.start[i]:self.end[i]].decode("utf-8", "surrogatepass")


def gram_hashes(words: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hash of the n values from each place on; places with fewer left are absent."""
    if len(words) < n:
        return np.zeros(0, U)
    total = np.zeros(len(words) - n + 1, U)
    factor = mix(np.array([seed], U))[0] | U(1)
    for k in range(n):
        total = total * factor + words[k:len(words) - n + 1 + k]
    return mix(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    if have < width:
        gap = width - have
        x = np.minimum(x[:-gap], x[gap:])
    return x

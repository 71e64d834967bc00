"""Words of texts as numpy arrays: boundaries, 64-bit hashes and hashes of word windows.

Works on the UTF-8 bytes of many texts at a time. A word's hash is a polynomial
over random 64-bit byte values (computed from running sums), then mixed; a
window's hash is a polynomial over its word hashes. Equal word sequences have
equal hashes in every process; unequal ones differ but for odds near 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHUNK = 1 << 20         # bytes of text handled at a time; a longer text is a chunk of its own
SEGMENT = 1 << 16       # bytes whose running sum is built at once

U = np.uint64
# The multipliers of the splitmix64 finaliser.
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
GOLD = U(0x9E3779B97F4A7C15)

#: [\x20\x09-\x0D] parts words.
SPACE_TABLE = np.ones(256, bool)
SPACE_TABLE[[0x20, *range(0x09, 0x0E)]] = False
#: [\x00-\x2F\x3A-\x60\x7B-\x7F] parts words, after lower-casing.
ALNUM_TABLE = np.zeros(256, bool)
ALNUM_TABLE[0x30:0x3A] = ALNUM_TABLE[0x61:0x7B] = ALNUM_TABLE[0x80:] = True
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

BYTE_VALUES = np.random.Generator(np.random.PCG64(20240611)).integers(0, 2 ** 64, 256, dtype=U)


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (in place on its argument)."""
    h ^= h >> U(30)
    h *= MIX1
    h ^= h >> U(27)
    h *= MIX2
    h ^= h >> U(31)
    return h


class Powers:
    """r**i and r**-i modulo 2**64, grown as needed."""

    def __init__(self, r: int):
        self.r, self.inv = r, pow(r, -1, 2 ** 64)
        self.up = self.down = np.ones(1, U)

    def to(self, n: int):
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U(pow(self.r, k, 2 ** 64))])
            self.down = np.concatenate([self.down, self.down * U(pow(self.inv, k, 2 ** 64))])
        return self.up[:n], self.down


BYTE_POWERS, WORD_POWERS, WORD_POWERS_2 = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)


@dataclass
class Words:
    """Words of several texts, in order. ``first[d]:first[d + 1]`` are those of text ``d``."""

    raw: bytes             # the texts as found, one byte between two of them
    starts: np.ndarray     # byte where a word begins, and its end
    ends: np.ndarray
    first: np.ndarray
    at: np.ndarray         # byte where a text begins

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chunks(texts, limit: int = CHUNK):
    """Lists of (from, to) with about ``limit`` bytes of text each."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def encode(texts) -> list[bytes]:
    return [(t or "").encode("utf-8") for t in texts]


def split(texts: list[bytes], table: np.ndarray, lower: bool) -> tuple[Words, np.ndarray]:
    """Words of UTF-8 texts, and the bytes (lower-cased if asked) that hashes are made of."""
    raw = b"\n".join(texts)
    buf = np.frombuffer(raw.translate(LOWER) if lower else raw, np.uint8)
    inside = np.zeros(len(buf) + 2, bool)
    np.take(table, buf, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    first = np.searchsorted(starts, at)
    return Words(raw, starts, ends, first, at[:-1]), buf


def hash_pieces(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each piece ``buf[start:end]`` (ascending, not overlapping)."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        top = int(ends[j - 1])
        up, down = BYTE_POWERS.to(top - base)
        total = np.empty(top - base + 1, U)
        total[0] = 0
        np.cumsum(BYTE_VALUES[buf[base:top]] * up, out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(U) * GOLD
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, first: np.ndarray, size: int, powers: Powers = WORD_POWERS):
    """Hashes of all windows of ``size`` words, and a mask of the places where one begins inside its text."""
    n = len(words)
    ok = np.zeros(n, bool)
    if n < size:
        return np.zeros(n, U), ok
    up, down = powers.to(n)
    total = np.empty(n + 1, U)
    total[0] = 0
    np.cumsum(words * up, out=total[1:])
    out = np.zeros(n, U)
    m = n - size + 1
    out[:m] = mix((total[size:] - total[:m]) * down[:m] + U(size * int(GOLD) % 2 ** 64))
    last = np.repeat(first[1:], np.diff(first))
    ok[:m] = np.arange(m) + size <= last[:m]
    return out, ok


def sequence_hash(words: np.ndarray, powers: Powers = WORD_POWERS) -> np.uint64:
    """The hash of one whole sequence, equal to that of a window of its length."""
    return window_hashes(words, np.array([0, len(words)]), len(words), powers)[0][0]


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending: (hashes, bounds). A shorter text is one shingle."""
    hashes, ok = window_hashes(words, first, size)
    found = []
    for d in range(len(first) - 1):
        a, b = first[d], first[d + 1]
        if b - a >= size:
            found.append(np.unique(hashes[a:b - size + 1]))
        elif b > a:
            found.append(np.array([sequence_hash(words[a:b])], U))
        else:
            found.append(np.empty(0, U))
    bounds = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(x) for x in found], out=bounds[1:])
    return (np.concatenate(found) if found else np.empty(0, U)), bounds

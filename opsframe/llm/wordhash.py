"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from functools import cached_property, lru_cache
from hashlib import blake2b

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
#: Every ASCII byte that is no letter or digit.
MARKS = bytes(b for b in range(128) if not chr(b).isalnum())

# An odd multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Longer words are told apart by a digest.
LONG = 64
# The first n bytes of a piece of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(maxsize=2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Well spread bits; the constants are fixed values of a public mixer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of texts (UTF-8), A-Z in lower case: ``starts`` and ``ends`` in the joined
    bytes, and ``first``: text i has the words first[i] to first[i + 1] - 1."""

    def __init__(self, texts: list[bytes], separators: bytes = SPACES):
        lower, space = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
        lower[65:91] += 32
        space[list(separators)] = True
        data = lower[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        inside = np.concatenate([[False], ~space[data]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges) % 2:  # the last byte is a line feed, so this is for other separators
            edges = np.append(edges, len(data))
        self.starts, self.ends = edges[::2], edges[1::2]
        limits = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.first = np.searchsorted(self.starts, limits)
        self._data = data

    @cached_property
    def _sums(self) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(
            (self._data.astype(np.uint64) + np.uint64(1)) * _powers(self._room, _BASE)[: len(self._data)], dtype=np.uint64)])

    @property
    def _room(self) -> int:
        return 1 << max(10, int(len(self._data) + 1).bit_length())

    def hashes(self, seed: int = 0, prefix: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first ``prefix`` bytes, for features: polynomials
        modulo 2**64, of which two long words with one hash can be made."""
        ends = self.ends if prefix is None else np.minimum(self.ends, self.starts + prefix)
        sums = (self._sums[ends] - self._sums[self.starts]) * _powers(self._room, _INVERSE)[self.starts]
        return mix(sums ^ np.uint64((seed * 0xD1342543DE82EF95) % (1 << 64)))

    def keys(self) -> np.ndarray:
        """A hash of each word that stands for it where texts are compared: its length and its
        pieces of eight bytes, mixed one after the other; words over ``LONG`` bytes by digest."""
        sizes, padded = self.ends - self.starts, np.concatenate([self._data, np.zeros(8, np.uint8)])
        pieces = np.ndarray(len(self._data), "<u8", padded, strides=(1,))
        out = mix(sizes.astype(np.uint64) * np.uint64(_BASE))
        for k in range(0, LONG, 8):
            asked = np.flatnonzero((sizes > k) & (sizes <= LONG))
            if not len(asked):
                break
            piece = pieces[self.starts[asked] + k] & _FIRST[np.minimum(sizes[asked] - k, 8)]
            out[asked] = mix(out[asked] * np.uint64(_BASE) + piece)
        for w in np.flatnonzero(sizes > LONG):
            digest = blake2b(self._data[self.starts[w]:self.ends[w]].tobytes(), digest_size=8).digest()
            out[w] = int.from_bytes(digest, "little")
        return out

    def shingles(self, size: int, text: int, hashes: np.ndarray) -> np.ndarray:
        """The hashes of a text's runs of ``size`` words, in order; a text with fewer words
        has one run of them all, a text without words none."""
        own = hashes[self.first[text]:self.first[text + 1]]
        return shingled(own, size)


def shingled(words: np.ndarray, size: int) -> np.ndarray:
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_BASE) + words[k:len(words) - size + 1 + k])
    return out

"""Hashes of words and word windows over whole batches of texts, in numpy.

A batch of texts is one byte buffer. Every word gets a 64-bit hash from prefix sums of its bytes' random codes times
powers of an odd base (modulo 2^64), mixed at the end; windows of words combine the words' hashes. No Python code runs
per word.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(20240607)
_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C13)  # odd, 3 modulo 8
_BACK = U(pow(0x9E3779B97F4A7C13, -1, 2**64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FACTORS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (the splitmix finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse, grown when a longer buffer comes."""

    up = _powers(_BASE, 1 << 16)
    down = _powers(_BACK, 1 << 16)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n <= 1 << 22 and n > len(cls.up):
            size = 1 << (n - 1).bit_length()
            cls.up, cls.down = _powers(_BASE, size), _powers(_BACK, size)
        if n > len(cls.up):  # one very long text: not kept
            return _powers(_BASE, n), _powers(_BACK, n)
        return cls.up[:n], cls.down[:n]


class Words:
    """The words of a batch of texts: ``hash``, byte ``start`` and ``end`` in ``buffer`` of each, and ``doc``, the
    index of each word's text; ``first[i]`` to ``first[i + 1]`` are the words of text i."""

    def __init__(self, texts: list[bytes]):
        self.buffer = b"\n".join(texts) + b"\n"
        b = np.frombuffer(self.buffer, dtype=np.uint8)
        space = _SPACE[b]
        edge = np.diff(space.view(np.int8), prepend=np.int8(1))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        up, down = Powers.to(len(b))
        sums = np.empty(len(b) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_CODE[b] * up, out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.first = np.searchsorted(self.start, bounds)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def text(self, i: int) -> list[bytes]:
        """The words of text i."""
        return [self.buffer[s:e] for s, e in zip(self.start[self.first[i]:self.first[i + 1]],
                                                 self.end[self.first[i]:self.first[i + 1]], strict=True)]

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """For each word that begins a window of ``k`` words of its text: the word's index and the window's hash."""
        n = len(self.hash)
        if n < k:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        acc = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            acc += self.hash[i:n - k + 1 + i] * _FACTORS[(i + 13 * salt) % 64]
        at = np.flatnonzero(self.doc[:n - k + 1] == self.doc[k - 1:])
        return at, mix(acc[at] + U(salt))

    def content(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each text's whole word sequence (0 words: fixed values)."""
        n = len(self.hash)
        pos = np.arange(n) - np.repeat(self.first[:-1], self.count)
        out = []
        for seed in (U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)):
            pw = _powers(seed, int(self.count.max()) if len(self.count) else 0)
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(self.hash + seed) * pw[pos], dtype=np.uint64)])
            total = sums[self.first[1:]] - sums[self.first[:-1]]
            out.append(mix(total + self.count.astype(np.uint64) * seed))
        return out[0], out[1]

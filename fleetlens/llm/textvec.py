"""NumPy helpers over blocks of texts inside a task: words, word hashes and shingle hashes.

A block's texts lie in one byte buffer, separated by a line feed, so that every step is a
few vector operations per block whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def blocks(texts: Iterable[str | None], limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Runs of UTF-8 texts (null: empty) of about ``limit`` bytes; a longer text is a block of its own."""
    out, size = [], 0
    for t in texts:
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if out and size + len(b) > limit:
            yield out
            out, size = [], 0
        out.append(b)
        size += len(b) + 1
    if out:
        yield out


def slices(batches: Iterator, rows: int = 500) -> Iterator:
    """Arrow batches in slices of at most ``rows`` rows, so that what a task holds at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[base] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Texts of one block: ``buf`` bytes, ``start`` and ``end`` of each text in it."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.buf = np.frombuffer(b"\n".join(texts), dtype=np.uint8) if texts else np.zeros(0, np.uint8)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        self._prefix: np.ndarray | None = None

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every run of bytes above the space."""
        is_word = np.zeros(len(self.buf) + 2, dtype=np.int8)
        is_word[1:-1] = self.buf > 32
        edge = np.diff(is_word)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return start, end, np.searchsorted(self.end, start, side="right")

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes [start, end): equal bytes, equal hash, wherever they lie."""
        if self._prefix is None:
            n = len(self.buf)
            self._prefix = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * powers(_P, n), out=self._prefix[1:])
        h = (self._prefix[end] - self._prefix[start]) * powers(_P_INV, len(self.buf) + 1)[start]
        return mix(h ^ (end - start).astype(np.uint64))


def shingles(word_hash: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``k`` words; a text of 1..k-1 words is one shingle."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count) - count
    out_h, out_d = [], []
    if len(word_hash) >= k:
        h = np.zeros(len(word_hash) - k + 1, dtype=np.uint64)
        for j in range(k):
            h = h * np.uint64(_P) + word_hash[j:len(word_hash) - k + 1 + j]
        whole = doc[k - 1:] == doc[:len(doc) - k + 1]
        out_h.append(mix(h[whole]))
        out_d.append(doc[:len(doc) - k + 1][whole])
    for d in np.flatnonzero((count > 0) & (count < k)):
        h = np.uint64(count[d])
        with np.errstate(over="ignore"):
            for x in word_hash[first[d]:first[d] + count[d]]:
                h = h * np.uint64(_P) + x
        out_h.append(mix(np.array([h], dtype=np.uint64)))
        out_d.append(np.array([d]))
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, d = np.concatenate(out_h), np.concatenate(out_d)
    order = np.argsort(d, kind="stable")
    return h[order], d[order]

"""Vectorised words, word hashes and shingle hashes over blocks of UTF-8 texts.

A block is a run of whole documents joined by spaces; memory is a small
multiple of the block, that is of ``BLOCK`` bytes or of the longest single
document, whichever is larger. Hashes are 64-bit; two different words or
shingles are taken as equal with a chance of about 2**-64 a pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U64 = np.uint64
_B = 0x9E3779B97F4A7C15
_BINV = pow(_B, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: words of [^\x20\x09-\x0D]+
NONSPACE = np.ones(256, bool)
NONSPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_POW = np.ones(1, U64)
_INV = np.ones(1, U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            p, q = np.full(size, U64(_B)), np.full(size, U64(_BINV))
            p[0] = q[0] = 1
            _POW, _INV = np.cumprod(p, dtype=U64), np.cumprod(q, dtype=U64)
    return _POW[:n], _INV[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix)."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class Block:
    """Documents ``lo:hi`` of a batch with their words."""

    def __init__(self, lo: int, texts: list[bytes]):
        self.lo, self.n = lo, len(texts)
        self.buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        self.len = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.off = np.concatenate([[0], np.cumsum(self.len + 1)])[:-1]

    def spans(self, table: np.ndarray, lower: bool = True) -> "Spans":
        return Spans(self, table, lower)

    def words(self, table: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and each document's bounds in that list (n + 1 numbers)."""
        s = self.spans(table, lower)
        return s.hashes(), s.bounds


class Spans:
    """Places of a block's words; hashes of them and of their first bytes."""

    def __init__(self, block: Block, table: np.ndarray, lower: bool):
        b = LOWER[block.buf] if lower else block.buf
        d = np.diff(table[b].view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(d == 1), np.flatnonzero(d == -1)   # the last byte is a space
        pw, self.inv = _powers(len(b))
        self.pre = np.zeros(len(b) + 1, U64)
        np.cumsum(_BYTE[b] * pw, out=self.pre[1:])
        self.bounds = np.searchsorted(self.starts, np.concatenate([block.off, [len(b)]]))

    def hashes(self) -> np.ndarray:
        return mix((self.pre[self.ends] - self.pre[self.starts]) * self.inv[self.starts])

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(which words, hashes of their first k bytes) for words of k bytes or more."""
        w = np.flatnonzero(self.ends - self.starts >= k)
        at = self.starts[w]
        return w, mix((self.pre[at + k] - self.pre[at]) * self.inv[at] + _TAG[k])


def texts_of(batch: pa.RecordBatch, col: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [t or b"" for t in batch.column(col).cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[Block]:
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > size:
            yield Block(lo, texts[lo:i])
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield Block(lo, texts[lo:])


_C = mix(np.arange(1, 65, dtype=U64)) | U64(1)
_TAG = mix(np.arange(1001, 1066, dtype=U64))


def window_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (across the whole array)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    s = words[:n] * _C[0]
    for j in range(1, k):
        s += words[j:j + n] * _C[j]
    return mix(s + _TAG[k])


def shingle_sets(words: np.ndarray, bounds: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each document; with fewer words the
    whole sequence is one shingle, without words the set is empty."""
    sh = window_hash(words, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            yield np.unique(sh[a:b - k + 1])
        elif b > a:
            yield window_hash(words[a:b], b - a)
        else:
            yield np.zeros(0, U64)

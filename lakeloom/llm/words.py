"""Words of many texts at once, as numpy arrays of positions and 64-bit hashes.

A word's hash is a polynomial in its code points modulo 2**64, taken as the
difference of two running sums, so its cost is a few array operations whatever
the number of words. Two words of one vocabulary get the same hash with a chance
of about (words ** 2) / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Code points hashed together; bounds the working memory.
PIECE = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _powers(inverse: bool, length: int) -> np.ndarray:
    base = 0xD6E8FEB86659FD93
    base = pow(base, -1, 1 << 64) if inverse else base
    steps = np.full(length, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    codes: np.ndarray  # code points of all texts, a line feed between them
    space: np.ndarray  # which of them are white space
    starts: np.ndarray  # per word
    ends: np.ndarray
    first: np.ndarray  # per text, and one more: its first word
    at: np.ndarray  # per text, and one more: its first code point

    def hashes(self) -> np.ndarray:
        """The hash of every word."""
        out = np.empty(len(self.starts), np.uint64)
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + PIECE)))
            low, high = self.starts[a], self.ends[b - 1]
            n = int(high - low)
            length = max(PIECE, 1 << n.bit_length()) + 1
            # a code point plus one, so that none counts as nothing
            values = (self.codes[low:high].astype(np.uint64) + np.uint64(1)) * _ODD
            values ^= values >> np.uint64(29)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values * _powers(False, length)[:n], out=sums[1:])
            s, e = self.starts[a:b] - low, self.ends[a:b] - low
            out[a:b] = (sums[e] - sums[s]) * _powers(True, length)[s]
            a = b
        return mixed(out)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per word over each text."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


def split(texts: list[str], lower: bool = False) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of every text; ``lower`` lower-cases A-Z first."""
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    if lower:
        codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]  # the last code point is a line feed, so every word ends
    if len(codes) == 0:
        starts = ends = np.empty(0, np.int64)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    return Words(codes, space, starts, ends, np.searchsorted(starts, at), at)


def slices(batch: pa.RecordBatch, column: str = "text", chars: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with about so many characters; a longer text is a part of its own, a null one is empty."""
    texts = [t or "" for t in batch.column(column).to_pylist()]
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield batch.slice(start, i - start), texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]

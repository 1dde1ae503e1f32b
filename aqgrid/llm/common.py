"""Helpers that the training-data operators share.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``: just what ``bytes.split()`` cuts out of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from aqgrid.sources.scratch import discard, fresh_dir, shared_dir, written

__all__ = ["Words", "chunks", "discard", "fresh_dir", "mix", "shared_dir", "utf8", "written"]

#: Bytes of text that one vectorised step works on; bounds the memory of a task.
CHUNK_BYTES = 4 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Multipliers for the words of a window or shingle.
STEP = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _word_hashes(buf: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words: sums over their bytes, each times a multiplier of its place."""
    base = int(start[0])
    a = np.frombuffer(buf, np.uint8, int(end[-1]) - base, base)
    size = end - start + 1
    place = np.arange(len(a)) - np.repeat(start - base, size)[: len(a)]
    if int(size.max()) <= len(_PLACE):
        v = _PLACE[place]
    else:  # in very long words the multipliers differ by block of 4,096, too
        v = _PLACE[place & 4095] * (mix((place >> 12).astype(np.uint64)) | np.uint64(1))
    v *= _BYTE[a]
    v[end[:-1] - base] = 0
    return mix(np.add.reduceat(v, start - base) + size.astype(np.uint64))


class Words:
    """The words of several texts in one buffer, with 64-bit hashes and the text each belongs to."""

    def __init__(self, texts: list[bytes]):
        counts, parts = [], []
        for t in texts:
            w = t.split()
            counts.append(len(w))
            if w:
                parts.append(b" ".join(w))
        self.buf = b" ".join(parts)
        self.counts = np.array(counts, np.int64)
        n = int(self.counts.sum())
        self.n = n
        self.of = np.repeat(np.arange(len(texts), dtype=np.int32), self.counts)
        self.first = np.cumsum(self.counts) - self.counts
        if not n:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        gaps = np.flatnonzero(np.frombuffer(self.buf, np.uint8) == 32)
        self.start = np.concatenate(([0], gaps + 1))
        self.end = np.concatenate((gaps, [len(self.buf)]))
        self.hash = np.empty(n, np.uint64)
        at = 0
        while at < n:  # in steps, as hashing needs some 30 bytes for each byte of text
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + (1 << 19), side="right")))
            self.hash[at:to] = _word_hashes(self.buf, self.start[at:to], self.end[at:to])
            at = to

    def grams(self, k: int) -> np.ndarray:
        """Hashes of the k words from each place on; of n - k + 1 places, also those that run over a text's end."""
        if self.n < k:
            return np.zeros(0, np.uint64)
        m = self.n - k + 1
        out = self.hash[:m] * STEP[0]
        for j in range(1, k):
            out += self.hash[j : j + m] * STEP[j]
        return mix(out)

    def whole(self, k: int) -> np.ndarray:
        """Places at which k words of one text start."""
        return self.of[: self.n - k + 1] == self.of[k - 1 :] if self.n >= k else np.zeros(0, bool)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece have at most ``limit`` bytes, or are one."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null gives an empty one."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]

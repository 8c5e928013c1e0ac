"""Whole batches of texts as byte arrays: words, word hashes and shingles without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one after the other, and where each text begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pa.compute.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8) if n and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = 4_000_000):
    """Cut a batch into slices of about ``most`` bytes of text, at least one row each, so memory stays bounded."""
    import pyarrow.compute as pc

    size = np.cumsum(np.nan_to_num(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


class Words:
    """The words of some texts: start, length, 64-bit hash, and the first word of each text.

    A word is a longest run of the bytes that ``classes`` marks, by default ``[^\\x20\\x09-\\x0D]+``.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = True, classes: np.ndarray = _WORD):
        n = len(data)
        buf = np.zeros(n + 16, np.uint8)
        buf[:n] = _LOWER[data] if lower else data
        word = classes[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        begin = word & (~before | edge[:n])
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        end = word & (~after | edge[1:])
        self.buf = buf
        self.start = np.flatnonzero(begin)
        self.length = np.flatnonzero(end) - self.start + 1
        self.first = np.searchsorted(self.start, off)
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        view = np.ndarray((len(self.buf) - 7,), np.dtype("<u8"), self.buf, 0, (1,))
        h = mix(self.length.astype(np.uint64) * K1 + K2)
        at, left, who = self.start, self.length, None
        while len(at):
            part = view[at] & _MASK[np.minimum(left, 8)]
            if who is None:
                h = mix((h ^ part) * K3 + K1)
            else:
                h[who] = mix((h[who] ^ part) * K3 + K1)
            more = np.flatnonzero(left > 8)
            who = more if who is None else who[more]
            at, left = at[more] + 8, left[more] - 8
        return h

    def same(self, i: np.ndarray, other: Words, j: np.ndarray) -> np.ndarray:
        """Whether the words ``i`` are, byte for byte, the words ``j`` of ``other``."""
        here, there = (np.ndarray((len(w.buf) - 7,), np.dtype("<u8"), w.buf, 0, (1,)) for w in (self, other))
        ok = self.length[i] == other.length[j]
        at = np.flatnonzero(ok)
        x, y, left = self.start[i[at]], other.start[j[at]], self.length[i[at]]
        while len(at):
            differ = (here[x] ^ there[y]) & _MASK[np.minimum(left, 8)] != 0
            ok[at[differ]] = False
            more = np.flatnonzero(~differ & (left > 8))
            at, x, y, left = at[more], x[more] + 8, y[more] + 8, left[more] - 8
        return ok

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.start[i] + self.length[i]].tobytes()

    def shingles(self, k: int):
        """For each text the sorted distinct hashes of its k-word shingles; of fewer words, the whole as one."""
        h = self.hash
        n = len(h)
        full = np.zeros(n, np.uint64)
        for j in range(k):
            m = max(n - j, 0)
            full[:m] = mix(full[:m] * K3 + h[j:] + np.uint64(j))
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= k:
                yield np.unique(full[a : b - k + 1])
            elif b > a:
                x = np.full(1, b - a, np.uint64)
                for v in h[a:b]:
                    x = mix(x * K2 + v)
                yield x
            else:
                yield np.zeros(0, np.uint64)

    def sequences(self) -> np.ndarray:
        """Two 64-bit hashes of each text's whole word sequence."""
        pos = np.arange(len(self.hash), dtype=np.uint64) - np.repeat(self.first[:-1], np.diff(self.first)).astype(np.uint64)
        out = np.zeros((len(self.first) - 1, 2), np.uint64)
        for c, k in enumerate((K1, K2)):
            cum = np.zeros(len(pos) + 1, np.uint64)
            np.cumsum(mix(self.hash ^ mix(pos * k + k)), out=cum[1:])
            out[:, c] = mix(cum[self.first[1:]] - cum[self.first[:-1]] + np.diff(self.first).astype(np.uint64) * k)
        return out

"""Elias-Fano coded levels of an n-gram trie, searched in batches with numpy.

A non-decreasing sequence keeps the low bits of its values packed and the high bits in unary. A level of a
trie has pointers (where the successors of each context begin, a monotone sequence), the successors (monotone
when counted on from context to context) and a quantised value for each. All arrays of a trie lie in one
memory map.
"""

from __future__ import annotations

import mmap

import numpy as np

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8)
_POP = _BITS.sum(1).astype(np.int64)
_PICK = np.zeros((256, 8), np.int64)  # the place of the k-th set bit of a byte
for byte in range(256):
    places = np.flatnonzero(_BITS[byte])
    _PICK[byte, : len(places)] = places

#: Masks of pairs, fours and eights of bits, the lowest and the highest bit of each byte.
_TWOS, _FOURS, _BYTES, _EACH, _TOPS = (np.uint64(x * 0x0101010101010101) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays, copied into one memory map of their own."""
    offsets, size = [], 0
    for a in arrays:
        offsets.append(size)
        size += -(-a.nbytes // 8) * 8 + 8
    space = mmap.mmap(-1, max(8, size))
    out = []
    for a, offset in zip(arrays, offsets, strict=True):
        view = np.frombuffer(space, a.dtype, a.size, offset)
        view[:] = a
        out.append(view)
    return out


class EliasFano:
    def __init__(self, values: np.ndarray, universe: int):
        """``values``: non-decreasing, below ``universe``."""
        self.n = n = len(values)
        self.shift = max(0, int(universe // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.shift)).astype(np.int64)
        flags = np.zeros(-(-(n + (universe >> self.shift) + 2) // 64) * 64, np.uint8)
        flags[high + np.arange(n)] = 1
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = _POP[words.view(np.uint8)].reshape(-1, 8).sum(1)
        low = np.zeros((n * self.shift + 7) // 8 + 8, np.uint8)
        if self.shift and n:
            bits = ((values[:, None] >> np.arange(self.shift, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(bits.ravel(), bitorder="little")
            low[: len(packed)] = packed
        counts = lambda x: np.concatenate([[0], np.cumsum(x)]).astype(np.uint32)
        self.words, self.ones, self.zeros, self.low = mapped([words, counts(ones), counts(64 - ones), low])

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the rank-th one or zero of the unary part."""
        before = self.ones if ones else self.zeros
        at = np.searchsorted(before, rank, side="right") - 1
        rest, word = rank - before[at], self.words[at]
        if not ones:
            word = ~word
        # Counts of bits in bytes, summed up to each byte; the byte is as far as sums are at most the rest.
        pairs = word - (word >> np.uint64(1) & _TWOS)
        nibbles = (pairs & _FOURS) + (pairs >> np.uint64(2) & _FOURS)
        upto = (nibbles + (nibbles >> np.uint64(4)) & _BYTES) * _EACH
        wanted = rest.astype(np.uint64)
        skipped = ((wanted * _EACH | _TOPS) - upto & _TOPS) >> np.uint64(7)
        byte_at = (skipped * _EACH >> np.uint64(56)) * np.uint64(8)
        wanted = wanted - (upto << np.uint64(8) >> byte_at & np.uint64(255))
        byte = (word >> byte_at & np.uint64(255)).astype(np.int64)
        return at.astype(np.int64) * 64 + byte_at.astype(np.int64) + _PICK[byte, wanted.astype(np.int64)]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.shift
        window = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        return (window[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.shift) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(i.astype(np.int64), True) - i).astype(np.uint64)
        return (high << np.uint64(self.shift)) | self._low(i)

    def find(self, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of ``keys`` within [start, end), -1 where absent (values are distinct there)."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not len(keys):
            return out
        high = (keys >> np.uint64(self.shift)).astype(np.int64)
        lo = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - (high - 1), 0)
        hi = self._select(high, False) - high
        lo, hi = np.maximum(lo, start), np.minimum(hi, end)
        want, live = keys & np.uint64((1 << self.shift) - 1), np.flatnonzero(lo < hi)
        while len(live):  # bisect on the low bits among values with the same high bits
            mid = (lo[live] + hi[live]) >> 1
            got = self._low(mid)
            hit = got == want[live]
            out[live[hit]] = mid[hit]
            less = got < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[~hit]
            live = live[lo[live] < hi[live]]
        return out


class Level:
    """Successors of numbered contexts with a quantised log10 probability each, and a back-off per context. Each
    n-gram may carry a ``weight``, its own back-off as a context of the next level."""

    STEP = 2048.0

    def __init__(self, context: np.ndarray, successor: np.ndarray, log_p: np.ndarray, backoff: np.ndarray, span: int, weight: np.ndarray | None = None):
        """``context`` (sorted) and ``successor`` (sorted within it, below ``span``) of each n-gram."""
        n_contexts = len(backoff)
        self.span = span
        starts = np.searchsorted(context, np.arange(n_contexts + 1))
        self.pointers = EliasFano(starts, len(context) + 1)
        self.successors = EliasFano(context.astype(np.uint64) * np.uint64(span) + successor.astype(np.uint64), n_contexts * span + 1)
        quantise = lambda x: np.clip(np.rint(-x * self.STEP), 0, 65535).astype(np.uint16)
        self.values, self.backoffs, self.weights = mapped([quantise(log_p), quantise(backoff), quantise(np.zeros(0) if weight is None else weight)])

    def _place(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        bounds = self.pointers.access(np.arange(len(self.backoffs) + 1)).astype(np.int64)  # of all contexts, as queries are more
        start, end = bounds[context], bounds[context + 1]
        return self.successors.find(context.astype(np.uint64) * np.uint64(self.span) + successor.astype(np.uint64), start, end)

    def _value(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return values[np.maximum(at, 0)] / -self.STEP if len(values) else np.zeros(len(at))

    def search(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each successor follows its context, its log10 probability there, and the context's back-off."""
        at = self._place(context, successor)
        return at >= 0, self._value(self.values, at), self.backoffs[context] / -self.STEP

    def search_with_weight(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``search``, and the weight of each n-gram, 0 where absent."""
        at = self._place(context, successor)
        return at >= 0, self._value(self.values, at), self.backoffs[context] / -self.STEP, np.where(at >= 0, self._value(self.weights, at), 0.0)

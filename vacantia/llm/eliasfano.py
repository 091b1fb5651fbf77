"""Monotone numbers in little more than their entropy, searched in place, many at a time.

A number is cut into low bits, kept side by side, and a high part, kept in unary in one bit vector: bit ``high + i``
is set for the i-th number. Counts per 512 bits find the i-th set or unset bit. All of it lies in a
buffer, which may be a memory map; nothing is decoded but what a question touches.
"""

from __future__ import annotations

import numpy as np

#: Numbers that are taken apart at a time.
SLICE = 1 << 16
#: One question for so many bits is answered by a pass over all bits.
MANY = 16
_BYTES = np.arange(8, dtype=np.uint64) * np.uint64(8)


def _bits_to_words(positions: np.ndarray, length: int) -> np.ndarray:
    bits = np.zeros(-(-max(length, 1) // 512) * 512, np.uint8)
    bits[positions] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


class EliasFano:
    """Numbers in order, equal ones allowed; ``keep`` puts an array where it is to stay and returns it."""

    def __init__(self, values: np.ndarray, keep=lambda a: a):
        self.size = len(values)
        most = int(values[-1]) if self.size else 0
        self.width = max(0, (most // max(1, self.size)).bit_length() - 1)
        lows = np.zeros(-(-self.size * self.width // 8) + 8, np.uint8)
        for begin in range(0, self.size, SLICE):  # a slice takes whole bytes
            low = values[begin : begin + SLICE]
            bits = np.empty((len(low), self.width), np.uint8)
            for k in range(self.width):
                bits[:, k] = (low >> k) & 1
            packed = np.packbits(bits.ravel(), bitorder="little")
            lows[begin * self.width // 8 :][: len(packed)] = packed
        self.lows = keep(lows)
        high = values >> self.width
        self.length = (int(high[-1]) if self.size else 0) + self.size + 1
        self.words = keep(_bits_to_words(high + np.arange(self.size), self.length))
        ones = np.bitwise_count(self.words).reshape(-1, 8).sum(axis=1, dtype=np.int64)
        self.ones = keep(np.concatenate([[0], np.cumsum(ones)]).astype(np.int64))

    def _select(self, which: np.ndarray, bit: int) -> np.ndarray:
        """Place of the given bits that equal ``bit``, counted from 0."""
        if len(which) * MANY > self.length:  # about all of them are asked for: one pass over the bits
            bits = np.unpackbits(self.words.view(np.uint8), bitorder="little")
            return np.flatnonzero(bits == bit)[which]
        before = self.ones if bit else np.arange(len(self.ones)) * 512 - self.ones
        block = np.searchsorted(before, which, side="right") - 1
        rest = which - before[block]
        word, place = np.zeros(len(which), np.uint64), block * 512
        found = np.zeros(len(which), bool)
        for k in range(8):  # the word of the block
            own = self.words[block * 8 + k]
            own = own if bit else ~own
            count = np.bitwise_count(own)
            here = ~found & (rest < count)
            word[here], place[here] = own[here], place[here] + 64 * k
            found |= here
            rest = np.where(found, rest, rest - count)
        for width in (32, 16, 8, 4, 2, 1):  # the half of the word, and so on
            count = np.bitwise_count(word & np.uint64((1 << width) - 1))
            upper = rest >= count
            rest = rest - np.where(upper, count, 0)
            word = np.where(upper, word >> np.uint64(width), word)
            place = place + np.where(upper, width, 0)
        return place

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.int64)
        bit = at * self.width
        byte = bit >> 3
        window = np.zeros(len(at), np.uint64)
        for k in range((self.width + 14) // 8):  # as many bytes as a number may touch
            window |= self.lows[byte + k].astype(np.uint64) << _BYTES[k]
        return ((window >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self._select(at, 1) - at) << self.width) | self._low(at)

    def successor(self, value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the numbers from ``begin`` to before ``end``, the place of the first that is not below; whether it is equal."""
        if not self.size:
            return begin, np.zeros(len(value), bool)
        last = self.length - self.size - 1  # the largest high part
        high = value >> self.width
        reach = np.minimum(high, last)
        stop = self._select(reach, 0) - reach
        start = np.where(reach > 0, self._select(np.maximum(reach - 1, 0), 0) - np.maximum(reach - 1, 0), 0)
        beyond = high > last
        low, high_end = np.where(beyond, stop, start), stop
        low, high_end = np.clip(low, begin, end), np.clip(high_end, begin, end)
        limit, wanted = high_end.copy(), value & ((1 << self.width) - 1)
        while len(active := np.flatnonzero(low < high_end)):  # halves the numbers of one high part
            middle = (low[active] + high_end[active]) >> 1
            less = self._low(middle) < wanted[active]
            low[active] = np.where(less, middle + 1, low[active])
            high_end[active] = np.where(less, high_end[active], middle)
        equal = (low < limit) & ~beyond
        equal[equal] = self._low(low[equal]) == wanted[equal]
        return low, equal

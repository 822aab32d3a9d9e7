"""Spark's own random numbers (``XORShiftRandom``), many at a time."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MASK = (1 << 64) - 1
# States that are worked out together: the n-th of them and the n-th of the
# next as many are one linear map apart.
LANES_LOG2 = 14


def _murmur3(data: bytes, seed: int) -> int:
    """Scala's ``MurmurHash3.bytesHash`` of whole words."""
    mask, mixed = 0xFFFFFFFF, seed
    for start in range(0, len(data), 4):
        word = int.from_bytes(data[start : start + 4], "little") * 0xCC9E2D51 & mask
        word = (word << 15 | word >> 17) & mask
        mixed ^= word * 0x1B873593 & mask
        mixed = (mixed << 13 | mixed >> 19) & mask
        mixed = mixed * 5 + 0xE6546B64 & mask
    mixed ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        mixed = (mixed ^ mixed >> shift) * factor & mask
    return mixed ^ mixed >> 16


def first_state(seed: int) -> int:
    """The state a generator of this seed starts from."""
    data = (seed & _MASK).to_bytes(8, "big")
    low = _murmur3(data, 0x3C074A61)
    return _murmur3(data, low) << 32 | low


def next_state(state: int) -> int:
    state ^= state << 21 & _MASK
    state ^= state >> 35
    return state ^ (state << 4 & _MASK)


def next_int(seed: int) -> int:
    """The first ``nextInt()`` of a generator."""
    low = next_state(first_state(seed)) & 0xFFFFFFFF
    return low - (1 << 32) if low >> 31 else low


def _advance(tables: np.ndarray, states: np.ndarray) -> np.ndarray:
    """The states a linear map makes of these, with a table per byte."""
    made = tables[0].take((states & 0xFF).astype(np.intp))
    for byte in range(1, 8):
        made ^= tables[byte].take((states >> np.uint64(8 * byte) & 0xFF).astype(np.intp))
    return made


def _tables(columns: np.ndarray) -> np.ndarray:
    tables = np.zeros((8, 256), dtype=np.uint64)
    for bit in range(64):
        byte, place = divmod(bit, 8)
        tables[byte, 1 << place : 2 << place] = tables[byte, : 1 << place] ^ columns[bit]
    return tables


def _jumps() -> list[np.ndarray]:
    """Tables of 1, 2, 4, ... steps at once."""
    columns = np.array([next_state(1 << bit) for bit in range(64)], dtype=np.uint64)
    jumps = [_tables(columns)]
    for _ in range(LANES_LOG2):
        columns = _advance(jumps[-1], columns)
        jumps.append(_tables(columns))
    return jumps


class Doubles:
    """The ``nextDouble()`` of one generator, in order."""

    def __init__(self, seed: int):
        jumps = _jumps()
        states = np.array([next_state(first_state(seed))], dtype=np.uint64)
        for jump in jumps[:-1]:
            states = np.concatenate([states, _advance(jump, states)])
        self.jump, self.states, self.left = jumps[-1], states, self._doubles(states)

    @staticmethod
    def _doubles(states: np.ndarray) -> np.ndarray:
        high = (states[::2] & np.uint64((1 << 26) - 1)) << np.uint64(27)
        return (high + (states[1::2] & np.uint64((1 << 27) - 1))) * 2.0**-53

    def take(self, count: int) -> np.ndarray:
        parts = [self.left]
        while sum(map(len, parts)) < count:
            self.states = _advance(self.jump, self.states)
            parts.append(self._doubles(self.states))
        drawn = np.concatenate(parts)
        self.left = drawn[count:]
        return drawn[:count]

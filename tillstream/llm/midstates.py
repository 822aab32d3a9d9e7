"""SHA-256 over many messages at once, with states that can be kept and resumed.

``hashlib`` copies states but cannot store them. Messages here are runs of
digests as hexadecimal text: 64 bytes each, which is one block of SHA-256, so
the state after any number of digests is eight 32-bit words.
"""

from __future__ import annotations

import numpy as np


def _roots(power: int, count: int) -> list[int]:
    """The first 32 bits of the fractional parts of roots of the first primes."""
    primes, number = [], 2
    while len(primes) < count:
        if all(number % p for p in primes):
            primes.append(number)
        number += 1
    bits = []
    for prime in primes:
        # whole root of prime * 2^(32 * power), by halving
        low, high = 0, prime << 32
        while low < high:
            middle = (low + high + 1) // 2
            if middle**power <= prime << (32 * power):
                low = middle
            else:
                high = middle - 1
        bits.append(low & 0xFFFFFFFF)
    return bits


ROUNDS = np.array(_roots(3, 64), np.uint32)
START = np.array(_roots(2, 8), np.uint32)
_HEX = np.frombuffer(b"".join(b"%02x" % k for k in range(256)), np.uint16)


def start(rows: int) -> np.ndarray:
    return np.tile(START, (rows, 1))


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """(n, 32) digest bytes as the (n, 16) words of their hexadecimal text."""
    text = _HEX[digests]
    return np.ascontiguousarray(text).view(np.uint8).view(">u4").astype(np.uint32)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def update(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block (n, 16) or (1, 16) each."""
    w = [np.ascontiguousarray(blocks[:, k]) for k in range(16)]
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(states[:, k]) for k in range(8))
    for k in range(64):
        if k >= 16:
            x, y = w[k - 15], w[k - 2]
            small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
            large = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
            w.append(w[k - 16] + small + w[k - 7] + large)
        mixed = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g))
        mixed = mixed + ROUNDS[k] + w[k]
        other = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = mixed + other, a, b, c, d + mixed, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def finish(states: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """(n, 32) digest bytes of states that have taken ``digests`` (n) digests."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 0x80000000
    last[:, 15] = np.asarray(digests) * 512
    return update(states, last).astype(">u4").view(np.uint8).reshape(-1, 32)

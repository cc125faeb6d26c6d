"""SHA-256 over many messages at once, with states that can be stored and resumed.

``hashlib`` can copy a state but not hand it to another task. Here a state is eight 32-bit words, so
it fits a column. Messages are concatenations of digests written as hex; such a digest is 64
characters, just one block, so a state between two digests has no pending bytes. Arrays have one
row per message.
"""

from __future__ import annotations

import math

import numpy as np

#: Messages worked on at once: many, so that a step costs more than its call.
LANES = 16_384

_BYTES = np.uint32(0x01010101)


def _primes(n: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < n:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def _cube_root(n: int) -> int:
    root = 1 << -(-n.bit_length() // 3)
    while root**3 > n:
        root = (2 * root + n // root**2) // 3
    return root


# By definition the first bits behind the point of square and cube roots of primes.
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    words = list(block)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        if t >= 16:
            near, far = words[(t - 2) % 16], words[(t - 15) % 16]
            word = _turned(near, 17) ^ _turned(near, 19) ^ (near >> np.uint32(10))
            word += _turned(far, 7) ^ _turned(far, 18) ^ (far >> np.uint32(3))
            word += words[(t - 7) % 16]
            word += words[t % 16]
            words[t % 16] = word
        first = _turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)
        first += (e & (f ^ g)) ^ g
        first += h
        first += words[t % 16] + _ROUND[t]
        second = _turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)
        second += (a & b) | (c & (a | b))
        h, g, f, e, d, c, b, a = g, f, e, d + first, c, b, a, first + second
    return state + np.stack([a, b, c, d, e, f, g, h])


def absorb_blocks(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n x 8) after one more block (n x 16) each."""
    out = np.empty_like(states)
    for at in range(0, len(states), LANES):
        part = slice(at, at + LANES)
        lanes = np.ascontiguousarray(states[part].T), np.ascontiguousarray(blocks[part].T)
        out[part] = _compress(*lanes).T
    return out


def as_hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 8 words) as the block of their 64 lower-case hex characters (n x 16 words)."""
    halves = np.stack([digests >> np.uint32(16), digests & np.uint32(0xFFFF)], axis=2).reshape(len(digests), 16)
    nibbles = (halves & np.uint32(0xF)) | ((halves & np.uint32(0xF0)) << np.uint32(4))
    nibbles |= ((halves & np.uint32(0xF00)) << np.uint32(8)) | ((halves & np.uint32(0xF000)) << np.uint32(12))
    letters = ((nibbles + _BYTES * np.uint32(6)) >> np.uint32(4)) & _BYTES
    return nibbles + _BYTES * np.uint32(ord("0")) + letters * np.uint32(ord("a") - ord("0") - 10)


def absorb(states: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States after one more digest, written as hex, each."""
    return absorb_blocks(states, as_hex_block(digests))


def finish(states: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Digests of messages that end here, ``taken`` digests long."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 1 << 31
    bits = taken.astype(np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorb_blocks(states, last)


def started(n: int) -> np.ndarray:
    """``n`` states of empty messages."""
    return np.tile(START, (n, 1))


def from_bytes(digests: bytes) -> np.ndarray:
    """Concatenated digests as rows of eight words."""
    return np.frombuffer(digests, ">u4").astype(np.uint32).reshape(-1, 8)


def to_bytes(words: np.ndarray) -> list[bytes]:
    """One bytes value per row."""
    data, width = words.astype(">u4").tobytes(), 4 * words.shape[1]
    return [data[i : i + width] for i in range(0, len(data), width)]

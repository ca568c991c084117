"""SHA-256 over many nodes in lockstep, with states that can be stored and resumed.

A digest goes into its parent as hex text, 64 bytes, which is one block of SHA-256. So the state
before a child's slot is the eight words after the blocks of the children on its left, and a fold
resumes from that state with the new child and the children on its right alone.
"""

from __future__ import annotations

import numpy as np

STATE_BYTES = 32
_M32 = 0xFFFFFFFF


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _root_bits(prime: int, power: int) -> int:
    """The first 32 bits of the fraction of a prime's square or cube root."""
    scaled = prime << (32 * power)
    low, high = 0, 1 << 40
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**power <= scaled else (low, middle)
    return low & _M32


FIRST = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
_ROUND = np.array([_root_bits(p, 3) for p in _primes(64)], np.uint32)


def _hex_words() -> np.ndarray:
    """The four hex digits of every 16-bit number as one big-endian word."""
    n = np.arange(1 << 16, dtype=np.uint32)
    out = np.zeros(1 << 16, np.uint32)
    for shift in (12, 8, 4, 0):
        digit = (n >> np.uint32(shift)) & np.uint32(15)
        out = (out << np.uint32(8)) | (digit + np.where(digit < 10, 48, 87).astype(np.uint32))
    return out


_HEX = _hex_words()


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """``(n, 8)`` states after one ``(n, 16)`` block each."""
    w = [np.ascontiguousarray(blocks[:, i]) for i in range(16)]
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        large = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[i - 16] + small + w[i - 7] + large)
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(states[:, i]) for i in range(8))
    for i in range(64):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25))
        one += (g ^ (e & (f ^ g))) + _ROUND[i] + w[i]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """The block that each of ``(n, 32)`` digests fills as hex text."""
    return _HEX[np.ascontiguousarray(digests).view(">u2").reshape(-1, 16)]


def last_blocks(children: np.ndarray) -> np.ndarray:
    """What ends a message of so many digests."""
    out = np.zeros((len(children), 16), np.uint32)
    out[:, 0] = 1 << 31
    bits = children.astype(np.uint64) * np.uint64(512)
    out[:, 14], out[:, 15] = bits >> np.uint64(32), bits & np.uint64(_M32)
    return out


def to_rows(states: np.ndarray) -> np.ndarray:
    """``(n, 8)`` words as ``(n, 32)`` bytes, big-endian."""
    return np.ascontiguousarray(states.astype(">u4")).view(np.uint8).reshape(-1, STATE_BYTES)


def to_states(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(">u4").reshape(-1, 8).astype(np.uint32)


def resume(
    states: np.ndarray, child: np.ndarray, pool: np.ndarray, first: np.ndarray, right: np.ndarray, size: np.ndarray
) -> np.ndarray:
    """Digests of parents whose slot takes ``child``, from the state before that slot.

    ``pool[first : first + right]`` are the digests right of the slot; ``size`` is the number
    of the parent's children. Nothing on the left is read.
    """
    now = compress(states, hex_blocks(child))
    for step in range(int(right.max(initial=0))):
        on = np.flatnonzero(right > step)
        now[on] = compress(now[on], hex_blocks(pool[first[on] + step]))
    return to_rows(compress(now, last_blocks(size)))


def build(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(states, digests)`` of parents of ``pool[first : first + size]``.

    ``states`` has one row of 32 bytes for each child, in order: the state before its slot.
    """
    now = np.tile(FIRST, (len(size), 1))
    starts = np.concatenate([[0], np.cumsum(size)])[:-1]
    kept = np.zeros((int(size.sum()), STATE_BYTES), np.uint8)
    for step in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > step)
        kept[starts[on] + step] = to_rows(now[on])
        now[on] = compress(now[on], hex_blocks(pool[first[on] + step]))
    return kept, to_rows(compress(now, last_blocks(size)))

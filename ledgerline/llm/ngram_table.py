"""An open-addressed NumPy table that interns the n-grams of a batch.

Keys are xxhash64 values of the n-grams' bytes; an equal key counts as the
same n-gram only if the bytes are equal.  All occurrences probe together, in
rounds: free slots are claimed, claimed slots compared, the rest move on.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

from .arrays import U

# fixed values: the primes of XXH64
P1, P2, P3 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
P4, P5 = U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)
#: From so many bytes on, XXH64 works in stripes: the xxhash library hashes those one by one.
STRIPE = 32


def _crc_steps() -> np.ndarray:
    """Effect of each low byte on a reflected CRC-32, from its polynomial."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
    return step


CRC_STEPS = _crc_steps()


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


class Bytes:
    """A byte buffer whose 8 bytes from any place on are one unsigned number."""

    def __init__(self, buffer: np.ndarray):
        self.raw = buffer.tobytes()
        padded = np.frombuffer(self.raw + bytes(16), np.uint8)
        n = len(buffer) + 8
        self.eight = np.empty(n, U)
        for k in range(8):
            part = self.eight[k::8]
            part[:] = np.frombuffer(padded, "<u8", count=len(part), offset=k)

    def xxhash64(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """XXH64 (seed 0) of the slices."""
        out = np.empty(len(start), U)
        long = np.flatnonzero(size >= STRIPE)
        for i, a, n in zip(long.tolist(), start[long].tolist(), size[long].tolist()):
            out[i] = xxhash.xxh64_intdigest(self.raw[a:a + n])
        short = np.flatnonzero(size < STRIPE)
        at, left = start[short].copy(), size[short].copy()
        h = P5 + left.astype(U)
        for _ in range(STRIPE // 8 - 1):
            m = np.flatnonzero(left >= 8)
            if not len(m):
                break
            lane = _rotate(self.eight[at[m]] * P2, 31) * P1
            h[m] = _rotate(h[m] ^ lane, 27) * P1 + P4
            at[m] += 8
            left[m] -= 8
        m = np.flatnonzero(left >= 4)
        h[m] = _rotate(h[m] ^ ((self.eight[at[m]] & U(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[m] += 4
        left[m] -= 4
        for _ in range(3):
            m = np.flatnonzero(left > 0)
            h[m] = _rotate(h[m] ^ ((self.eight[at[m]] & U(0xFF)) * P5), 11) * P1
            at[m] += 1
            left[m] -= 1
        h ^= h >> U(33)
        h *= P2
        h ^= h >> U(29)
        h *= P3
        h ^= h >> U(32)
        out[short] = h
        return out

    def crc32(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """CRC-32 of the slices, byte by byte over all that are long enough."""
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
        long = int(np.searchsorted(-size, -2 * STRIPE, side="right"))
        data = np.frombuffer(self.raw, np.uint8)
        for i in range(int(size[long]) if long < len(size) else 0):
            upto = int(np.searchsorted(-size, -i, side="left"))
            c = crc[long:upto]
            crc[long:upto] = CRC_STEPS[(c ^ data[start[long:upto] + i]) & np.uint32(0xFF)] ^ (c >> np.uint32(8))
        crc ^= np.uint32(0xFFFFFFFF)
        for i, a, n in zip(range(long), start[:long].tolist(), size[:long].tolist()):
            crc[i] = zlib.crc32(self.raw[a:a + n])
        out = np.empty_like(crc)
        out[order] = crc
        return out

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the slices of ``size`` bytes at ``a`` and at ``b`` are equal."""
        equal = np.ones(len(a), bool)
        long = np.flatnonzero((size >= 2 * STRIPE) & (a != b))
        for i, x, y, n in zip(long.tolist(), a[long].tolist(), b[long].tolist(), size[long].tolist()):
            equal[i] = self.raw[x:x + n] == self.raw[y:y + n]
        short = np.flatnonzero((size < 2 * STRIPE) & (a != b))
        x, y, left = a[short], b[short], size[short]
        ok = np.ones(len(short), bool)
        while len(left) and (left > 0).any():
            unused = U(8) * np.clip(8 - left, 0, 7).astype(U)
            differ = ((self.eight[x] ^ self.eight[y]) << unused) != 0
            ok &= ~(differ & (left > 0))
            go = left > 8
            x, y, left = np.where(go, x + 8, x), np.where(go, y + 8, y), np.where(go, left - 8, 0)
        equal[short] = ok
        return equal


def intern(text: Bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each occurrence, and the occurrence that claimed each slot (-1: free)."""
    n = len(start)
    key = text.xxhash64(start, size)
    slots = 1 << max(4, int(2 * n - 1).bit_length() if n else 0)
    owner = np.full(slots, -1, np.int64)
    slot = np.empty(n, np.int64)
    open_, at = np.arange(n), (key & U(slots - 1)).astype(np.int64)
    while len(open_):
        free = owner[at] < 0
        owner[at[free]] = open_[free]
        held = owner[at]
        equal = (key[held] == key[open_]) & (size[held] == size[open_])
        check = np.flatnonzero(equal)
        equal[check] = text.same(start[held[check]], start[open_[check]], size[open_[check]])
        slot[open_[equal]] = at[equal]
        open_, at = open_[~equal], (at[~equal] + 1) & (slots - 1)
    return slot, owner

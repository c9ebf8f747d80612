"""Words of texts and hashes of runs of bytes or words, by whole arrays.

A run's hash is a polynomial over random 64-bit values of its units, mod 2**64, mixed; it doesn't depend on where the run stands. Long texts
go in blocks, so powers are kept for one block only. Words stand between ASCII white space (blank, and 9 to 13).
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 16
#: Longest run that is asked for beside a block.
BESIDE = 1 << 12
BASE = 0x9E3779B97F4A7C15
ONE, MIX = np.uint64(1), np.uint64(0xC2B2AE3D27D4EB4F)

VALUES = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + ONE
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\r\x0b\x0c")] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def joined(raws: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Texts one behind the other, a line end between them, and where each begins and ends."""
    sizes = np.array([len(r) for r in raws], np.int64)
    end = np.cumsum(sizes + 1) - 1
    return b"\n".join(raws), end - sizes, end


def words_of(raws: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``words`` of texts one behind the other, and which of them belong to each text (from, to)."""
    raw, begin, end = joined(raws)
    code, at, stop = words(raw, lower)
    return code, at, stop, np.searchsorted(at, begin), np.searchsorted(at, end)


def powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + BESIDE, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS, INVERSE = powers(BASE), powers(pow(BASE, -1, 2**64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


class Sums:
    """Prefix sums of at most BLOCK + BESIDE units (bytes, or hashes of words)."""

    def __init__(self, code: np.ndarray):
        self.sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((VALUES[code] if code.dtype == np.uint8 else code) * POWERS[: len(code)], out=self.sums[1:])

    def hashes(self, length: int, at: np.ndarray | None = None) -> np.ndarray:
        """Of the runs of ``length`` that start at these places, or at all."""
        s = self.sums
        if at is None:
            return mixed((s[length:] - s[: len(s) - length]) * INVERSE[: len(s) - length])
        return mixed((s[at + length] - s[at]) * INVERSE[at])

    def between(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[at]) * INVERSE[at]


def long_word(b: np.ndarray) -> int:
    """The same sum as ``between``, block by block."""
    total, far, step = 0, 1, pow(BASE, BLOCK, 2**64)
    for low in range(0, len(b), BLOCK):
        total = (total + far * int(Sums(b[low : low + BLOCK]).sums[-1])) % 2**64
        far = far * step % 2**64
    return total


def words(raw: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word; lower: A-Z count as a-z."""
    b = np.frombuffer(raw, np.uint8)
    if lower:
        b = LOWER[b]
    edges = np.flatnonzero(np.diff(SPACE[b], prepend=True, append=True))
    at, end = edges[::2], edges[1::2]
    if len(b) <= BLOCK:
        return mixed(Sums(b).between(at, end)) if len(at) else np.zeros(0, np.uint64), at, end
    out, k = np.zeros(len(at), np.uint64), 0
    while k < len(at):
        # as many words as one block holds
        j = int(np.searchsorted(end, at[k] + BLOCK, "right"))
        if j == k:
            out[k], j = np.uint64(long_word(b[at[k] : end[k]])), k + 1
        else:
            out[k:j] = Sums(b[at[k] : end[j - 1]]).between(at[k:j] - at[k], end[k:j] - at[k])
        k = j
    return mixed(out), at, end

"""Word hashes of many texts at once, as numpy arrays, for use inside Spark tasks.

A word is a run of bytes other than space and 0x09-0x0D, so UTF-8 text needs no decoding.  The hash of a word is a
polynomial over random byte values modulo 2**64, taken from prefix sums, and then mixed.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.common import worker_memo

SLICE_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64 - 1, n, dtype=np.uint64)


def odd(seed: int, n: int) -> np.ndarray:
    return _random(seed, n) | np.uint64(1)


BYTE_VALUES = _random(11, 256)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a fixed invertible function)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least `n` of each; a worker keeps them."""
    kept = worker_memo("powers", dict)
    if len(kept.get("up", ())) < n:
        for name, step in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(n + n // 4, step, np.uint64)
            steps[0] = 1
            kept[name] = np.cumprod(steps, dtype=np.uint64)
    return kept["up"], kept["down"]


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES):
    """Ranges of rows of about `limit` bytes; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text or b"") + 1
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes | None], lower: bool = False, space: np.ndarray = IS_SPACE):
    """Hash of every word of the texts in order, and where each text's words begin (one more entry than texts)."""
    texts = [t or b"" for t in texts]
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    gap = space[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    begins = np.concatenate(([0], np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)))) + 1
    return hashes, np.searchsorted(starts, begins)


def windows(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of each run of `size` neighbouring values; entry i starts at value i."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, weight in enumerate(odd(seed, size)):
        total += hashes[j : j + n] * weight
    return mix(total)

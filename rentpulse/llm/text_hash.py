"""Rolling hashes over bytes, vectorised."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(41).integers(0, 1 << 64, 256, dtype=np.uint64)


class _Powers:
    """Powers of the base and its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Powers.up) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            setattr(_Powers, name, np.multiply.accumulate(steps))
    return _Powers.up[:n], _Powers.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes, the empty one first."""
    up, _ = _powers(max(len(data), 1))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[: len(data)], out=out[1:])
    return out


def prefix_hashes_of(values: np.ndarray) -> np.ndarray:
    """As ``prefix_hashes``, of a sequence of integers."""
    up, _ = _powers(max(len(values), 1))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values.astype(np.uint64)) * up[: len(values)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes in [start, end), equal for equal bytes wherever they are."""
    _, down = _powers(max(len(prefix), 1))
    raw = (prefix[end] - prefix[start]) * down[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_ranks(prefix: np.ndarray, length: int) -> np.ndarray:
    """A pseudo-random number, good in its high bits, for the ``length`` bytes from every place on."""
    _, down = _powers(len(prefix))
    out = prefix[length:] - prefix[:-length]
    out *= down[: len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out

"""Hashes of character runs over whole batches of folded texts (numpy, no per-character Python)."""

from __future__ import annotations

import numpy as np

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_S = np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the input reaches every bit of the output."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> _S
    return h


_powers: dict[str, np.ndarray] = {}


def _power(n: int, key: str, base: int) -> np.ndarray:
    have = _powers.get(key)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _powers[key] = have = out
    return have[:n]


def window_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every run of ``q`` code points of ``x``; one entry per start, runs may cross texts."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    v = mix(x.astype(np.uint64) + np.uint64(0x51ED27))
    up = _power(len(x), "up", _BASE)
    down = _power(len(x), "down", pow(_BASE, -1, 1 << 64))
    sums = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(v * up, out=sums[1:])
    return mix((sums[q:] - sums[:n]) * down[:n])


def inside(bounds: np.ndarray, q: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts whose run stays within its text, and the text of each."""
    lengths = np.diff(bounds)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    start = np.arange(len(owner))
    ok = start + q <= bounds[owner + 1]
    return start[ok], owner[ok]


def text_hash(x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each whole text."""
    out = []
    lengths = np.diff(bounds).astype(np.uint64)
    owner = np.repeat(np.arange(len(lengths)), np.diff(bounds))
    place = (np.arange(len(x)) - bounds[owner]).astype(np.uint64)
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        v = mix(x.astype(np.uint64) * np.uint64(salt | 1) + mix(place + np.uint64(salt)))
        sums = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(v, out=sums[1:])
        out.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + mix(lengths + np.uint64(salt))).view(np.int64))
    return out[0], out[1]


def sliding(h: np.ndarray, w: int, how) -> np.ndarray:
    """``how`` (np.minimum / np.maximum) over each window of ``w`` entries."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    pad = -len(h) % w
    worst = np.uint64(0xFFFFFFFFFFFFFFFF) if how is np.minimum else np.uint64(0)
    a = np.concatenate([h, np.full(pad, worst, dtype=np.uint64)]).reshape(-1, w)
    left = how.accumulate(a, axis=1).ravel()
    right = how.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return how(right[:n], left[w - 1 : w - 1 + n])


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values (numpy's own function hashes, which takes several times as long on long arrays)."""
    a = np.sort(a)
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def distinct_runs(x: np.ndarray, q: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of one text."""
    return distinct(window_hashes(x, q))

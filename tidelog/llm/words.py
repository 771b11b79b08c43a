"""Vectorised words of many texts at once: offsets, owners and 64-bit identities.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. Texts are laid end to end
with a newline between them, so neither words nor lines cross documents. Identities are
polynomial hashes over random byte values, taken from one running sum, then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, each followed by a newline
    bounds: np.ndarray  # where each text starts; one more than there are texts
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    prefix: np.ndarray

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = _power_tables(len(self.data) + 1)[1]
        h = (self.prefix[end] - self.prefix[start]) * inverse[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)


def words_of(texts: list[bytes]) -> Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    space = _SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge[1:] == 1) + 1
    power = _power_tables(len(data) + 1)[0]
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[: len(data)], out=prefix[1:])
    return Words(data, bounds, start, end, np.searchsorted(bounds, start, "right") - 1, prefix)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it there at least twice; is an equal key before it."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    if len(s) > 1:
        same[1:-1] = s[1:] == s[:-1]
    twice, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    twice[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return twice, later


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of each run of n identities, by doubling."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    out, done, block, width = None, 0, ids.astype(np.uint64, copy=False), 1
    rest = n
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                part = block[done : done + len(ids) - n + 1]
                out = part.copy() if out is None else mix(out * np.uint64(0x9FB21C651E98DF25) + part)
                done += width
            rest >>= 1
            if rest:
                block = mix(block[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) + block[width:])
                width *= 2
    return out

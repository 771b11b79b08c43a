"""Elias-Fano sequences in memory-mapped files.

A monotone sequence of n values below u keeps the low bits of each as they are, packed, and the
high bits as a unary bitmap: about log2(u / n) + 2 bits a value. Counts of ones and of zeros before each word
of the bitmap serve select and the successor search; they are kept in 32 bits, so a sequence has fewer than
2^31 values. Queries in ascending order touch the maps in order.
"""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

_ONE = np.uint64(1)
_EACH, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


def _select_in_byte() -> np.ndarray:
    """[byte, k] -> place of its k-th one."""
    out = np.zeros((256, 8), np.uint8)
    for b in range(256):
        for k, p in enumerate(i for i in range(8) if b >> i & 1):
            out[b, k] = p
    return out


_PLACE = _select_in_byte()


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray | int]:
    """values: sorted uint64 below universe."""
    n = len(values)
    values = values.astype(np.uint64, copy=False)
    low = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
    high = (values >> np.uint64(low)).astype(np.int64)
    n_high = int((universe - 1) >> low) + 1 if universe else 1
    bits = np.zeros(-(-(n + n_high + 1) // 64) * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    upper = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])
    if ones[-1] + len(bits) >= 1 << 32:
        raise ValueError(f"{n} values are too many for one sequence")
    zeros = (np.arange(len(ones), dtype=np.int64) * 64 - ones).astype("<u4")
    words = np.zeros(n * low // 64 + 2, np.uint64)
    if low and n:
        at = np.arange(n, dtype=np.int64) * low
        v = values & np.uint64((1 << low) - 1)
        word, off = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, v << off)
        spill = off + np.uint64(low) > np.uint64(64)
        np.bitwise_or.at(words, word[spill] + 1, v[spill] >> (np.uint64(64) - off[spill]))
    return {"n": n, "low": low, "n_high": n_high, "upper": upper, "ones": ones.astype("<u4"), "zeros": zeros, "lower": words}


class EliasFano:
    def __init__(self, parts: dict):
        self.n, self.low, self.n_high = int(parts["n"]), int(parts["low"]), int(parts["n_high"])
        self.upper, self.ones, self.zeros, self.lower = parts["upper"], parts["ones"], parts["zeros"], parts["lower"]

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one, or zero, of the bitmap."""
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, k.astype(np.uint32), "right") - 1
        left = k - before[word]
        w = self.upper[word] if one else ~self.upper[word]
        # ones of each byte, their running sums, and the byte in which the wanted one lies, all within the word
        sums = w - (w >> np.uint64(1) & np.uint64(0x5555555555555555))
        sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
        sums = (sums + (sums >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH
        left = left.astype(np.uint64)
        byte = ((left * _EACH | _HIGH) - sums & _HIGH) >> np.uint64(7)
        shift = np.minimum(byte * _EACH >> np.uint64(56), np.uint64(7)) << np.uint64(3)
        inside = left - (sums << np.uint64(8) >> shift & np.uint64(255))
        return word * 64 + shift.astype(np.int64) + _PLACE[(w >> shift & np.uint64(255)).astype(np.int64), inside.astype(np.int64)]

    def _lower(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i * self.low
        word, off = at >> 6, (at & 63).astype(np.uint64)
        a = self.lower[word] >> off
        b = np.where(off > 0, self.lower[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return (a | b) & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return high << np.uint64(self.low) | self._lower(i)

    def _bucket(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the values with each key's high bits start and end, and the keys' low bits."""
        high = (key >> np.uint64(self.low)).astype(np.int64)
        h = np.minimum(high, self.n_high - 1)
        bit = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) + 1, 0)
        # the bucket is the run of ones from there: the ones at the end of the 64 bits that start there
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        after = np.where(word + 1 < len(self.upper), self.upper[np.minimum(word + 1, len(self.upper) - 1)], np.uint64(0))
        rest = ~(self.upper[word] >> off | np.where(off > 0, after << (np.uint64(64) - off & np.uint64(63)), np.uint64(0)))
        run = np.bitwise_count((rest & (np.uint64(0) - rest)) - _ONE).astype(np.int64)
        start = bit - h
        long = np.flatnonzero(run == 64)
        if len(long):
            run[long] = self._select(h[long], False) - bit[long]
        end = start + run
        beyond = high > h
        if beyond.any():
            start, end = np.where(beyond, self.n, start), np.where(beyond, self.n, end)
        return start, end, key & np.uint64((1 << self.low) - 1)

    def _first(self, a: np.ndarray, b: np.ndarray, want: np.ndarray) -> np.ndarray:
        """The first place in [a, b) whose low bits are not below `want`, or b."""
        a, b = a.copy(), b.copy()
        go = np.flatnonzero(a < b)
        while len(go):
            mid = (a[go] + b[go]) >> 1
            less = self._lower(mid) < want[go]
            a[go[less]], b[go[~less]] = mid[less] + 1, mid[~less]
            go = go[a[go] < b[go]]
        return a

    def successor(self, key: np.ndarray) -> np.ndarray:
        """Index of the first value that is not below the key (n if there is none)."""
        key = np.asarray(key, np.uint64)
        return self._first(*self._bucket(key)) if self.n else np.zeros(len(key), np.int64)

    def find(self, key: np.ndarray, bounds=None) -> np.ndarray:
        """Index of the key, or -1. `bounds(i)` tells the range in which the i-th keys' values lie; it narrows large buckets."""
        key = np.asarray(key, np.uint64)
        out = np.full(len(key), -1, np.int64)
        if not self.n:
            return out
        start, end, want = self._bucket(key)
        if bounds is not None and len(many := np.flatnonzero(end - start > 1)):
            low, high = bounds(many)
            start[many], end[many] = np.maximum(start[many], low), np.minimum(end[many], high)
        at = self._first(start, end, want)
        ok = np.flatnonzero(at < end)
        ok = ok[self._lower(at[ok]) == want[ok]]
        out[ok] = at[ok]
        return out


def save(path: str, arrays: dict[str, np.ndarray], meta: dict) -> None:
    """One file: a JSON line, then the arrays, eight bytes aligned; written aside and renamed."""
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 8) * 8
    line = json.dumps({"meta": meta, "arrays": head}).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        f.write(line)
        for a in arrays.values():
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    os.replace(part, path)


def load(path: str) -> tuple[dict[str, np.ndarray], dict]:
    """Memory-mapped arrays, and the meta data."""
    with open(path, "rb") as f:
        line = f.readline()
    head = json.loads(line)
    data = np.asarray(np.memmap(path, np.uint8, "r")) if os.path.getsize(path) > len(line) else np.zeros(len(line), np.uint8)
    arrays = {k: data[len(line) + at : len(line) + at + np.dtype(t).itemsize * n].view(t) for k, (t, n, at) in head["arrays"].items()}
    return arrays, head["meta"]


def pack(name: str, ef: dict) -> tuple[dict[str, np.ndarray], dict]:
    return {f"{name}.{k}": ef[k] for k in ("upper", "ones", "zeros", "lower")}, {f"{name}.{k}": ef[k] for k in ("n", "low", "n_high")}


def unpack(name: str, arrays: dict, meta: dict) -> EliasFano:
    return EliasFano({k: arrays[f"{name}.{k}"] for k in ("upper", "ones", "zeros", "lower")} | {k: meta[f"{name}.{k}"] for k in ("n", "low", "n_high")})

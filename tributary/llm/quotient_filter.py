"""Counting quotient filters of whole keys: sorted, compact, mergeable and lossless.

A key is two halves of ``half`` bits each.  An invertible permutation (a
Feistel network) spreads the keys evenly over their range; the upper bits of
the permuted key are its quotient, all others its remainder, and both are
kept, so that every key can be read back.  A filter holds one bit per quotient
(occupied or not), one bit per entry (whether it ends the run of its
quotient), the remainders in whole bytes, and counters of one byte with an
escape for larger ones.  Entries are in order of the permuted key: filters are
merged like sorted lists, and filters cut at the same upper bits (segments)
can be merged segment by segment.
"""

from __future__ import annotations

import struct

import numpy as np

# Round keys (any odd numbers do) and the multipliers of the splitmix64 finaliser.
_ROUND_KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03)]
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_HEADER = struct.Struct("<QBBBQ")
_ESCAPED = 255

Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _FIRST
    x = (x ^ (x >> np.uint64(27))) * _SECOND
    return x ^ (x >> np.uint64(31))


def permute(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key (two halves of ``half`` bits, at most 64) under the permutation."""
    for key in _ROUND_KEYS:
        high, low = low, high ^ (_mix(low + key) & _mask(half))
    return high, low


def unpermute(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that ``permute`` took to these places."""
    for key in reversed(_ROUND_KEYS):
        high, low = low ^ (_mix(high + key) & _mask(half)), high
    return high, low


def _summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, half: int) -> Entries:
    """Entries in order, one per place, with their counts added up."""
    n = len(high)
    if not n:
        return high, low, np.empty(0, np.int64)
    if 2 * half <= 64:
        key = (high << np.uint64(half)) | low
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")  # runs that are sorted already are merged
            key, counts = key[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key = key[first]
        high, low = key >> np.uint64(half), key & _mask(half)
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        counts = None if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        high, low = high[first], low[first]
    if counts is None:
        return high, low, np.diff(np.append(first, n))
    return high, low, np.add.reduceat(counts, first)


def counted(high: np.ndarray, low: np.ndarray, half: int) -> Entries:
    """Count keys: (upper half, lower half) of their places in order, and how often each occurs."""
    return _summed(*permute(high, low, half), None, half)


def merge(parts: list[Entries], half: int) -> Entries:
    """One list of entries out of several; counts of equal keys are added up."""
    high, low, counts = (np.concatenate(x) for x in zip(*parts))
    return _summed(high, low, counts, half)


def segments(entries: Entries, half: int, bits: int) -> list[tuple[int, Entries]]:
    """The entries cut at their upper ``bits`` bits; empty segments are left out."""
    high, low, counts = entries
    if not len(high):
        return []
    segment = high >> np.uint64(half - bits)
    cuts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])).tolist() + [len(high)]
    return [(int(segment[a]), (high[a:b], low[a:b], counts[a:b])) for a, b in zip(cuts, cuts[1:])]


def _bytes_of(values: np.ndarray, bits: int) -> bytes:
    width = (bits + 7) // 8
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _values_of(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    width = (bits + 7) // 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return wide.view("<u8").reshape(n).astype(np.uint64), data[n * width:]


def pack(entries: Entries, half: int, bits: int) -> bytes:
    """The filter of one segment (its entries share their upper ``bits`` bits)."""
    high, low, counts = entries
    n = len(high)
    q = max(0, min(half - bits, n.bit_length() - 1))
    rest = half - bits - q
    quotient = ((high >> np.uint64(rest)) & _mask(q)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.concatenate([quotient[1:] != quotient[:-1], [True]])
    large = counts >= _ESCAPED
    return b"".join([
        _HEADER.pack(n, half, bits, q, int(large.sum())), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        _bytes_of(high & _mask(rest), rest), _bytes_of(low, half),
        np.where(large, _ESCAPED, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()])


def unpack(data: bytes, segment: int) -> tuple[Entries, int]:
    """The entries of a filter and the number of bits of half a key."""
    view = memoryview(data)
    n, half, bits, q, n_large = _HEADER.unpack_from(view)
    view = view[_HEADER.size:]
    width = ((1 << q) + 7) // 8
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(view, np.uint8, width), count=1 << q))
    view = view[width:]
    width = (n + 7) // 8
    ends = np.unpackbits(np.frombuffer(view, np.uint8, width), count=n)
    view = view[width:]
    run = np.cumsum(ends) - ends  # number of runs that ended before
    rest = half - bits - q
    upper, view = _values_of(view, n, rest)
    low, view = _values_of(view, n, half)
    counts = np.frombuffer(view, np.uint8, n).astype(np.int64)
    counts[counts == _ESCAPED] = np.frombuffer(view, "<i8", n_large, n)
    top = np.uint64(segment << (half - bits)) if bits else np.uint64(0)
    high = top | (occupied[run].astype(np.uint64) << np.uint64(rest)) | upper
    return (high, low, counts), half

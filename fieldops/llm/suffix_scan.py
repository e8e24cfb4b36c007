"""Repeated windows among short texts, by suffix order and the common lengths of neighbours.

Each text holds a place (its gram) that equal windows share.  The suffixes that start there are
sorted and neighbours' common lengths noted, as in a suffix array.  The suffixes that start one byte
earlier are then in order after one stable sort by that byte, so all starts down to the leftmost are
ordered byte by byte without comparing texts again.  A window that starts d bytes before the place
repeats if a neighbour in that order has the same d bytes and, behind the place, at least
window - d bytes in common: the least common length between the two in the first order.

Only bytes are compared: no fingerprint decides here.
"""
from __future__ import annotations

import numpy as np

from fieldops.llm import common as C


class _Least:
    """Least of a range of numbers, from the least of all ranges of 1, 2, 4, ... numbers."""

    def __init__(self, numbers: np.ndarray):
        self.levels = [numbers]
        while 2 ** len(self.levels) <= len(numbers):
            half, last = 2 ** (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))
        self.at = np.concatenate(([0], np.cumsum([len(x) for x in self.levels])))
        self.flat = np.concatenate(self.levels)

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of numbers[a:b], each a < b."""
        k = np.frexp((b - a).astype(np.float64))[1] - 1
        return np.minimum(self.flat[self.at[k] + a], self.flat[self.at[k] + b - (1 << k)])


def _common_lengths(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many bytes each buf[start:start + size] has in common with the next one."""
    out = np.minimum(size[:-1], size[1:])
    for lo in range(0, len(out), 4096):
        a = np.arange(lo, min(lo + 4096, len(out)))
        n = out[a]
        ends = np.cumsum(n)
        differ = np.flatnonzero(buf[C.ranges(start[a], n)] != buf[C.ranges(start[a + 1], n)])
        first = np.searchsorted(differ, ends - n)
        found = np.append(differ, ends[-1])[first]
        out[a] = np.minimum(found - (ends - n), n)
    return out


def repeated(buf: np.ndarray, offs: np.ndarray, group: np.ndarray, place: np.ndarray, window: int,
             firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start) of each window that another text of the same group holds as far before its place, and
    (text, start) of one of each set of equal windows (that are one or more) of texts with ``firsts``.

    Starts count from the text's own; windows reach from at most the place to behind it."""
    data = buf.tobytes()
    order = np.array(sorted(range(len(group)), key=lambda i: (group[i], data[offs[i] + place[i]: offs[i + 1]])), np.int64)
    group, left, firsts, at = group[order], place[order], firsts[order], (offs[:-1] + place)[order]
    right = offs[1:][order] - at
    common = _common_lengths(buf, at, right)
    common[group[1:] != group[:-1]] = -1
    least = _Least(common) if len(common) else None
    alike = np.zeros(len(group), np.int64)  # texts with the same number share group and last d bytes before the place
    now = np.arange(len(group))  # suffix order of those that start d bytes before the place
    out: list[list[np.ndarray]] = [[], [], [], []]
    for d in range(int(left.max(initial=-1)) + 1):
        key = group[now]
        if d:
            key = key * 256 + buf[at[now] - d]
            by = np.argsort(key, kind="stable")
            now, key = now[by], key[by]
        new = np.ones(len(now) + 1, bool)
        new[1:-1] = (key[1:] != key[:-1]) | (alike[now[1:]] != alike[now[:-1]])
        alike[now] = np.cumsum(new[:-1])
        same = np.zeros(len(now) + 1, bool)  # equal windows as the one before
        near = np.flatnonzero(~new[1:-1])
        if len(near):
            same[near + 1] = least.between(now[near], now[near + 1]) >= window - d
        hits = now[same[:-1] | same[1:]]
        heads = now[~same[:-1] & firsts[now] & (right[now] >= window - d)]
        for spot, texts in ((0, hits), (2, heads)):
            out[spot].append(order[texts])
            out[spot + 1].append(left[texts] - d)
        alone = new[:-1] & new[1:]
        now = now[(left[now] > d) & (~alone | firsts[now])]
        if not len(now):
            break
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def places(buf: np.ndarray, offs: np.ndarray, gram: int, window: int, keys) -> np.ndarray:
    """Where, in each text, the gram stands that represents its first window; keys(hashes, places) orders
    grams, and its low bits are the place."""
    span = window - gram + 1
    prefix = C.prefix_hash(C.BYTE_VALUES[buf])
    out = []
    for lo in range(0, len(offs) - 1, 1024):
        first = offs[:-1][lo: lo + 1024]
        at = first[:, None] + np.arange(span)
        grams = C.range_hash(prefix, at.ravel(), at.ravel() + gram).reshape(at.shape)
        out.append(keys(grams, np.arange(span)).argmin(axis=1))
    return np.concatenate(out) if out else np.zeros(0, np.int64)

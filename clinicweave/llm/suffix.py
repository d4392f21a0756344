"""Suffix arrays by recursive induced sorting: with few characters numpy fills buckets a wave at a time, reduced
strings of many names are induced a suffix at a time. Both are linear."""

from __future__ import annotations

import numpy as np

#: Strings of up to so many different characters are induced in waves; each bucket costs some numpy calls.
WAVE_CHARACTERS = 1 << 10


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S), False where it is larger (L)."""
    n = len(s)
    out = np.ones(n, bool)
    if n > 1:
        differ = np.flatnonzero(s[:-1] != s[1:])
        lengths = np.diff(np.concatenate([[-1], differ]))
        out[: differ[-1] + 1] = np.repeat(s[differ] < s[differ + 1], lengths)
    return out


class _Induce:
    """Sort all suffixes from an order of the leftmost S suffixes (LMS)."""

    def __init__(self, s: np.ndarray, small: np.ndarray, sigma: int):
        self.s, self.small, self.sigma = s, small, sigma
        counts = np.bincount(s, minlength=sigma)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts

    def _deal(self, sa: np.ndarray, entries: np.ndarray, at: np.ndarray, step: int, want_small: bool) -> None:
        """Put the predecessors of ``entries`` of the wanted type into their buckets, in this order."""
        before = entries[entries > 0] - 1
        before = before[self.small[before] == want_small]
        if not len(before):
            return
        chars = self.s[before]
        order = np.argsort(chars, kind="stable")
        chars = chars[order]
        first = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
        sizes = np.diff(np.append(first, len(chars)))
        rank = np.arange(len(chars)) - np.repeat(first, sizes)
        sa[at[chars] + step * rank] = before[order]
        at[chars[first]] += step * sizes

    def run(self, lms: np.ndarray) -> np.ndarray:
        """``lms`` in the order that its suffixes or substrings have, of equal first characters at least."""
        return self._waves(lms) if self.sigma <= WAVE_CHARACTERS else self._singly(lms)

    def _singly(self, lms: np.ndarray) -> np.ndarray:
        s, small = self.s.tolist(), self.small.tolist()
        sa = [-1] * len(s)
        tail = (self.ends - 1).tolist()
        for p in reversed(lms.tolist()):
            c = s[p]
            sa[tail[c]] = p
            tail[c] -= 1
        head = self.starts.tolist()
        for p in sa:  # grows to the right while it is read
            if p > 0 and not small[p - 1]:
                c = s[p - 1]
                sa[head[c]] = p - 1
                head[c] += 1
        tail = (self.ends - 1).tolist()
        for p in reversed(sa):
            if p > 0 and small[p - 1]:
                c = s[p - 1]
                sa[tail[c]] = p - 1
                tail[c] -= 1
        return np.array(sa, np.int64)

    def _waves(self, lms: np.ndarray) -> np.ndarray:
        s, starts, ends = self.s, self.starts, self.ends
        sa = np.full(len(s), -1, np.int64)
        chars = s[lms]
        order = np.argsort(chars, kind="stable")
        lms, chars = lms[order], chars[order]
        lms_ends = np.searchsorted(chars, np.arange(self.sigma), "right")
        lms_starts = np.concatenate([[0], lms_ends[:-1]])
        used = np.flatnonzero(ends > starts).tolist()
        head = starts.copy()
        for c in used:
            done = starts[c]
            while done < head[c]:
                wave, done = sa[done : head[c]].copy(), head[c]
                self._deal(sa, wave, head, 1, False)
            self._deal(sa, lms[lms_starts[c] : lms_ends[c]], head, 1, False)
        larger = head.copy()  # end of the L part of each bucket
        tail = ends - 1
        sa[0] = len(s) - 1
        for c in reversed(used):
            done = ends[c] - 1
            while done > tail[c]:
                wave, done = sa[tail[c] + 1 : done + 1][::-1].copy(), tail[c]
                self._deal(sa, wave, tail, -1, True)
            self._deal(sa, sa[starts[c] : larger[c]][::-1], tail, -1, True)
        return sa


def _names(s: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Name of each LMS substring, by position in ``lms``; equal substrings share one, names follow the order."""
    place = np.empty(len(s), np.int64)
    place[lms] = np.arange(len(lms))
    following = np.append(lms[1:], lms[-1])
    length = following[place[ordered]] - ordered + 1
    same = np.zeros(len(ordered), bool)
    alive = np.flatnonzero(length[1:] == length[:-1]) + 1
    k = 0
    while len(alive):
        alive = alive[s[ordered[alive] + k] == s[ordered[alive - 1] + k]]
        k += 1
        over = length[alive] <= k
        same[alive[over]] = True
        alive = alive[~over]
    names = np.empty(len(lms), np.int64)
    names[place[ordered]] = np.cumsum(~same) - 1
    return names


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of integers below ``sigma``; the last one is 0 and the only 0."""
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _Induce(s, small, sigma)
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        sa = induce.run(lms)
        ordered = sa[is_lms[sa]]
        names = _names(s, ordered, lms)
        count = int(names.max()) + 1
        if count < len(lms):
            lms = lms[suffix_array(names, count)]
        else:
            lms = ordered
    return induce.run(lms)


def permuted_lcp(s: np.ndarray, sa: np.ndarray, sigma: int, least: int = 0) -> np.ndarray:
    """For each position the common prefix with the suffix before it in ``sa``; values below ``least`` may be too low.

    Only the irreducible values, where the characters before both differ, are compared, some characters at a time;
    each of the others is one less than its left neighbour's.
    """
    n = len(s)
    at = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, bool)
    reducible[1:] = (before[1:] > 0) & (s[:-1] == s[before[1:] - 1])
    bits = int(sigma).bit_length()
    step = 63 // bits
    words = np.zeros(n + step, np.int64)
    for i in range(step):
        words <<= bits
        words[: max(0, n - i)] |= s[i:] + 1
    out = np.zeros(n, np.int64)
    alive = np.flatnonzero(~reducible & (before >= 0))
    other, k = before[alive], 0
    while len(alive):
        same = words[np.minimum(alive + k, n)] == words[np.minimum(other + k, n)]
        if k + step >= least:
            left, right = alive[~same], other[~same]
            for i in range(step):
                x, y = np.minimum(left + k + i, n - 1), np.minimum(right + k + i, n - 1)
                equal = s[x] == s[y]
                left, right = left[equal], right[equal]
                out[left] += 1
        alive, other = alive[same], other[same]
        out[alive] += step
        k += step
    last = np.maximum.accumulate(np.where(reducible, 0, at))
    return np.where(reducible, np.maximum(out[last] - (at - last), 0), out)

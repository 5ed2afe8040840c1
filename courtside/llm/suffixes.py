"""Hash-compared suffix sort: mergesort whose comparisons find the common extension of two suffixes by binary search.

Suffixes are given by where they start and end in a buffer and are sorted within groups. Two suffixes are compared by the
longest length at which their polynomial hashes agree (a binary search over prefix hashes, so logarithmic in their
length) and by the byte after it. Merging is done by ranks: an element's place in a merged run is its place in its own
run plus the number of smaller elements in the sibling run, found by binary search; all runs of a level merge at once.
Hashes only ever claim equality, so the common extensions of neighbours are verified on the bytes in the end.
"""

from __future__ import annotations

import numpy as np

from courtside.llm.anchors import PrefixHashes


class Suffixes:
    def __init__(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        self.buf, self.start, self.length = buf, start, end - start
        self.hashes = PrefixHashes(buf)
        self.steps = max(1, int(self.length.max()).bit_length()) if len(start) else 1

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the common prefix of suffixes i and j, as far as hashes tell."""
        a, b = self.start[i], self.start[j]
        low = np.zeros(len(i), dtype=np.int64)
        high = np.minimum(self.length[i], self.length[j])
        for _ in range(self.steps + 1):
            mid = (low + high + 1) // 2
            same = self.hashes.of(a, a + mid) == self.hashes.of(b, b + mid)
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
            high = np.maximum(high, low)
        return low

    def less(self, i: np.ndarray, j: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix i sorts before suffix j; a suffix sorts before its extensions, equal ones as ``ties`` says."""
        n = self.common(i, j)
        i_ends, j_ends = n == self.length[i], n == self.length[j]
        top = len(self.buf) - 1
        byte = self.buf[np.minimum(self.start[i] + n, top)] < self.buf[np.minimum(self.start[j] + n, top)]
        return np.where(i_ends & j_ends, ties, np.where(i_ends, True, np.where(j_ends, False, byte)))

    def sort(self, group: np.ndarray) -> np.ndarray:
        """The order of the suffixes within groups; group is ascending."""
        n = len(group)
        order = np.arange(n)
        if not n:
            return order
        begin = np.searchsorted(group, group, "left")  # of each place, where its group begins and ends
        stop = np.searchsorted(group, group, "right")
        size, run = int((stop - begin).max()), 1
        while run < size:
            at = np.flatnonzero(stop - begin > run)  # groups that have a sibling run at this level
            inside = at - begin[at]
            mine = inside // run
            left = mine % 2 == 0
            sibling = begin[at] + np.where(left, mine + 1, mine - 1) * run
            low = np.minimum(sibling, stop[at])
            high = np.minimum(sibling + run, stop[at])
            base = low.copy()
            own = order[at]
            for _ in range(run.bit_length() + 1):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) // 2
                # elements of the left run stay before equal ones of the right run
                smaller = np.where(left[open_], self.less(order[mid], own[open_], False), self.less(order[mid], own[open_], True))
                low[open_] = np.where(smaller, mid + 1, low[open_])
                high[open_] = np.where(smaller, high[open_], mid)
            pair = begin[at] + (mine // 2) * 2 * run
            to = pair + inside % run + (low - base)
            merged = order.copy()
            merged[to] = own
            order = merged
            run *= 2
        return order

    def extensions(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """For each place of the order the verified common length with the place before it; -1 where a group begins."""
        out = np.full(len(order), -1, dtype=np.int64)
        at = np.flatnonzero(np.concatenate(([False], group[1:] == group[:-1]))) if len(order) else np.empty(0, np.int64)
        for part in np.array_split(at, max(1, len(at) // 50_000)):
            i, j = order[part - 1], order[part]
            n = self.common(i, j)
            if len(part) and n.max():
                reach = np.arange(int(n.max()))
                top = len(self.buf) - 1
                differ = self.buf[np.minimum(self.start[i][:, None] + reach, top)] != self.buf[np.minimum(self.start[j][:, None] + reach, top)]
                differ &= reach[None, :] < n[:, None]
                n = np.where(differ.any(axis=1), differ.argmax(axis=1), n)
            out[part] = n
        return out

"""Suffix trees of sequences of numbers, and longest common extensions in constant time.

``SuffixTree`` is built from left to right by Ukkonen's algorithm. Its Euler tour is a row of string depths; the
longest common prefix of two suffixes is the smallest depth between their leaves, found with a sparse table over
blocks of the tour. Queries are answered for whole arrays at once.
"""

import numpy as np

TOUR_BLOCK = 16


class SuffixTree:
    """Tree of ``text``, a list of non-negative numbers of which the last occurs nowhere else."""

    def __init__(self, text: list):
        self.text, self.radix = text, max(text) + 1
        self._build()

    def _build(self):
        """Nodes in the order of their making; ``child[node * radix + symbol]`` is the edge that starts with ``symbol``.

        ``begin`` is where a node's edge starts in the text, ``stop`` where it ends; a leaf's edge has no end.
        """
        text, radix, n = self.text, self.radix, len(self.text)
        child, begin, stop, link, suffix = {}, [0], [0], [0], [-1]
        node, edge, along, due = 0, 0, 0, 0
        for i, symbol in enumerate(text):
            due += 1
            unlinked = 0
            while due:
                if not along:
                    edge = i
                key = node * radix + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i), stop.append(n), link.append(0), suffix.append(i - due + 1)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = begin[below]
                    width = (stop[below] if suffix[below] < 0 else i + 1) - at
                    if along >= width:
                        edge += width
                        along -= width
                        node = below
                        continue
                    if text[at + along] == symbol:
                        along += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    middle = len(begin)
                    begin.append(at), stop.append(at + along), link.append(0), suffix.append(-1)
                    child[key] = middle
                    begin[below] = at + along
                    child[middle * radix + text[at + along]] = below
                    child[middle * radix + symbol] = middle + 1
                    begin.append(i), stop.append(n), link.append(0), suffix.append(i - due + 1)
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                due -= 1
                if node:
                    node = link[node]
                elif along:
                    along -= 1
                    edge = i - due + 1
        self.begin, self.stop, self.suffix = begin, stop, suffix
        keys = np.fromiter(child.keys(), np.int64, len(child))
        order = np.argsort(keys)
        keys, below = keys[order], np.fromiter(child.values(), np.int64, len(child))[order]
        self._symbol = keys % radix
        bounds = np.searchsorted(keys // radix, np.arange(len(begin) + 1))
        self._below, self._bounds = below.tolist(), bounds.tolist()

    def tour(self) -> "Extensions":
        """The Euler tour, made ready for queries."""
        begin, stop, suffix, below, bounds = self.begin, self.stop, self.suffix, self._below, self._bounds
        depths, first = [], [0] * len(self.text)
        stack = [(0, 0, bounds[0])]
        while stack:
            node, depth, at = stack.pop()
            depths.append(depth)
            last = bounds[node + 1]
            while at < last:
                x = below[at]
                at += 1
                if suffix[x] >= 0:
                    first[suffix[x]] = len(depths)
                    depths.append(len(self.text) - suffix[x])
                    depths.append(depth)
                else:
                    stack.append((node, depth, at))
                    stack.append((x, depth + stop[x] - begin[x], bounds[x]))
                    break
        return Extensions(np.array(depths, np.int32), np.array(first, np.int64))

    def suffix_ranks(self, largest_first: bool = False, ends: int = 0) -> list:
        """The rank of every suffix in lexicographic order; with ``largest_first`` in that of the reversed alphabet.

        Symbols below ``ends`` are marks; they come before all others in both orders.
        """
        suffix, below, bounds = self.suffix, self._below, self._bounds
        if largest_first:  # within each node: marks first, then the others from the largest down
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            place = np.where(self._symbol < ends, self._symbol - self.radix, -self._symbol)
            below = np.array(below)[np.lexsort((place, owner))].tolist()
        ranks, rank, stack = [0] * len(self.text), 0, [0]
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                ranks[suffix[node]] = rank
                rank += 1
            else:
                stack += below[bounds[node]:bounds[node + 1]][::-1]
        return ranks


class Extensions:
    """Longest common prefixes of suffixes, from string depths along the tour and each leaf's place in it."""

    def __init__(self, depths: np.ndarray, first: np.ndarray):
        self.first = first
        blocks = -(-len(depths) // TOUR_BLOCK)
        padded = np.full(blocks * TOUR_BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:len(depths)] = depths
        self.rows = padded.reshape(blocks, TOUR_BLOCK)
        self.left = np.minimum.accumulate(self.rows, axis=1).reshape(-1)
        self.right = np.minimum.accumulate(self.rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [self.rows.min(axis=1)]
        while 1 << len(self.levels) <= blocks:
            half = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How long the suffixes at ``a`` and at ``b``, which differ, agree."""
        low, high = np.minimum(self.first[a], self.first[b]), np.maximum(self.first[a], self.first[b])
        p, q = low // TOUR_BLOCK, high // TOUR_BLOCK
        out = np.minimum(self.right[low], self.left[high])
        same = np.flatnonzero(p == q)
        if len(same):
            column = np.arange(TOUR_BLOCK)
            inside = (column >= (low[same] % TOUR_BLOCK)[:, None]) & (column <= (high[same] % TOUR_BLOCK)[:, None])
            out[same] = np.where(inside, self.rows[p[same]], np.iinfo(np.int32).max).min(axis=1)
        between = np.maximum(q - p - 1, 0)
        level = np.frexp(np.maximum(between, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[between > 0]):
            at = np.flatnonzero((level == k) & (between > 0))
            table = self.levels[k]
            out[at] = np.minimum(out[at], np.minimum(table[p[at] + 1], table[q[at] - (1 << int(k))]))
        return out

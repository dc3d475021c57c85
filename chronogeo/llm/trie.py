"""A trie over sets of n-grams, and the joins of one set with all others by one walk.

The n-grams of the sets are put in one order, those that most sets hold first, and a set is the path of its n-grams in that
order. An edge holds a fixed number of them. Sets that begin alike share edges, so their overlap with the set that is joined
is added up once; a subtree is left as soon as the overlap so far and the most that can follow, by the lengths that remain on
either side, are too little for its smallest set. N-grams that only one set holds match nothing; they count in its size but
are not on its path, so a set of its own is left at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd

EDGE = 16  # n-grams on an edge, at least
DEPTH = 48  # edges on a path, at most


class Level(NamedTuple):
    above: np.ndarray  # node of the level above
    edge: np.ndarray  # n-grams on the way from there, padded
    last: np.ndarray  # the last of them
    rest: np.ndarray  # n-grams that follow in the longest set below
    least: np.ndarray  # size of the smallest set below
    sets: np.ndarray  # sets that come this far
    node: np.ndarray  # their nodes
    ends: np.ndarray  # whether they end here


class Trie:
    def __init__(self, sets: list[np.ndarray], percent: int):
        m = len(sets)
        self.percent, self.n = percent, np.array([len(s) for s in sets], np.int64)
        code = pd.factorize(np.concatenate(sets))[0].astype(np.int32)
        held = np.bincount(code)
        shared = held[code] > 1
        place = np.empty(len(held), np.int32)
        place[np.argsort(-held, kind="stable")] = np.arange(len(held), dtype=np.int32)
        owner = np.repeat(np.arange(m, dtype=np.int32), self.n)[shared]
        code = place[code[shared]]
        self.size = np.bincount(owner, minlength=m)
        self.first = np.append(0, np.cumsum(self.size))
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            code[a:b].sort()
        self.code, self.none = code, int((held > 1).sum())
        self.levels = self._grow()

    def _grow(self) -> list[Level]:
        step = max(EDGE, -(-int(self.size.max(initial=0)) // DEPTH))
        node, levels = np.zeros(len(self.n), np.int64), []
        sets, at = np.flatnonzero(self.size), 0
        while len(sets):
            width = np.minimum(self.size[sets] - at, step)
            spot = (self.first[sets] + at)[:, None] + np.arange(step)
            edge = np.where(np.arange(step) < width[:, None], self.code[np.minimum(spot, len(self.code) - 1)], np.int32(self.none))
            key = np.ascontiguousarray(np.column_stack([node[sets], edge]).astype(np.int32))
            _, head, own = np.unique(key.view(f"V{key.shape[1] * 4}").ravel(), return_index=True, return_inverse=True)
            rest = self.size[sets] - at - width
            most, least = np.zeros(len(head), np.int64), np.full(len(head), np.iinfo(np.int64).max)
            np.maximum.at(most, own, rest)
            np.minimum.at(least, own, self.n[sets])
            levels.append(Level(node[sets[head]], edge[head], edge[head, width[head] - 1], most, least, sets, own, rest == 0))
            node[sets] = own
            sets, at = sets[rest > 0], at + step
        return levels

    def need(self, x: int, n: np.ndarray) -> np.ndarray:
        """Overlap that links set x with sets of n: 100 I >= percent (n_x + n - I)."""
        return -(-(self.percent * (self.n[x] + n)) // (100 + self.percent))

    def join(self, x: int, open_: np.ndarray) -> np.ndarray:
        """The open sets that link with x."""
        mine = np.zeros(self.none + 1, bool)
        mine[self.code[self.first[x]:self.first[x + 1]]] = True
        passed = np.cumsum(mine)
        found, overlap, walked = [], None, None
        for level in self.levels:
            live = np.zeros(len(level.above), bool)
            live[level.node[open_[level.sets]]] = True
            if walked is not None:
                live &= walked[level.above]
            at = np.flatnonzero(live)
            if not len(at):
                break
            sums = mine[level.edge[at]].sum(1)
            if overlap is not None:
                sums += overlap[level.above[at]]
            most = sums + np.minimum(level.rest[at], self.size[x] - passed[level.last[at]])
            overlap, walked = np.zeros(len(level.above), np.int64), np.zeros(len(level.above), bool)
            overlap[at] = sums
            walked[at[most >= self.need(x, level.least[at])]] = True
            done = level.ends & walked[level.node] & open_[level.sets]
            y = level.sets[done]
            found.append(y[overlap[level.node[done]] >= self.need(x, self.n[y])])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def link_sets(sets: list[np.ndarray], percent: int, root: np.ndarray) -> np.ndarray:
    """For each set the smallest index that links lead to. The sets are sorted and not empty; `root` is what is known so far.

    Two sets of one class need no join, and a pair is settled by a join of either. So the sets of the largest class are
    never joined, unless it grew by that.
    """
    m, root = len(sets), root.copy()
    if m == 2 and root[0] != root[1]:
        n, shared = len(sets[0]) + len(sets[1]), len(np.intersect1d(*sets, assume_unique=True))
        root[1] = 0 if 100 * shared >= percent * (n - shared) else 1
    if m <= 2 or (root == root[0]).all():
        return root
    trie, left = Trie(sets, percent), np.ones(m, bool)
    while True:
        waiting = np.bincount(root[left], minlength=m)
        classes = np.flatnonzero(waiting)
        if len(classes) < 2:
            return root
        smallest = classes[np.argmin(waiting[classes])]
        x = int(np.flatnonzero(left & (root == smallest))[0])
        left[x] = False
        found = trie.join(x, left & (root != smallest))
        if len(found):
            joined = np.append(root[found], smallest)
            root[np.isin(root, joined)] = joined.min()

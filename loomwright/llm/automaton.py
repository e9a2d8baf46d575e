"""An Aho-Corasick automaton over passages of one length, as numpy arrays, that scans many texts side by side.

Goto, failure and output functions are the textbook ones.  The tree is built level by level
(the children of a level are the distinct pairs of node and sign), failure links follow
level by level, and goto lies in one hash table of (node, sign) with open addressing.  A scan cuts all texts into
lanes of :data:`LANE` signs that overlap by one passage less a sign, and moves all lanes one
sign at a time, so that a step costs a few array operations however many lanes there are.
As all passages have one length, a node has an output exactly if it is on the last level.

Equal passages are one pattern.  No passages make an automaton that never matches.
"""

from __future__ import annotations

import numpy as np

LANE = 256
DENSE = 1 << 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in a table of open addressing, at most half full (-1: free), and the node (place + 1) of each slot."""
    bits = max(4, len(keys).bit_length() + 1)
    table, nodes = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
    left = np.arange(len(keys))
    slot = ((keys.view(np.uint64) * _ODD) >> np.uint64(64 - bits)).view(np.int64)
    while len(left):
        free = np.flatnonzero(table[slot] < 0)
        table[slot[free]] = keys[left[free]]  # of several that want a slot one gets it
        mine = table[slot] == keys[left]
        nodes[slot[mine]] = left[mine] + 1
        left, slot = left[~mine], (slot[~mine] + 1) & ((1 << bits) - 1)
    return table, nodes


class Automaton:
    """``patterns`` of ``length`` signs; arrays only, so that it is written and read as it is."""

    ARRAYS = ("signs", "fail", "keys", "nodes")

    def __init__(self, length: int, leaves: int, patterns: int, arrays: dict[str, np.ndarray]):
        self.length, self.leaves, self.patterns = length, leaves, patterns
        self.signs, self.fail, self.keys, self.nodes = (arrays[n] for n in self.ARRAYS)
        self.shift = np.uint64(65 - len(self.keys).bit_length())
        self.width = np.int64(len(self.signs) + 1)
        self._shallow()
        code = np.zeros(0x110000, dtype=np.int32)  # signs of no passage are 0
        code[self.signs] = np.arange(1, len(self.signs) + 1)
        self.code = code

    @classmethod
    def build(cls, x: np.ndarray, at: np.ndarray, length: int) -> tuple["Automaton", np.ndarray]:
        """The automaton of the passages of ``x`` that begin at ``at``, and the pattern of each of them."""
        signs = np.unique(np.concatenate([x[:0], *(np.unique(x[at + d]) for d in range(length))]))
        code = np.zeros(0x110000, dtype=np.int64)
        code[signs] = np.arange(1, len(signs) + 1)
        width = len(signs) + 1
        node, base, levels = np.zeros(len(at), dtype=np.int64), 1, []
        for d in range(length):
            keys, where = np.unique(node * width + code[x[at + d]], return_inverse=True)
            levels.append((base, keys))
            node, base = base + where, base + len(keys)
        table, nodes = _table(np.concatenate([k for _, k in levels]))
        fail = np.zeros(base, dtype=np.int32)
        leaves = levels[-1][0]
        self = cls(length, leaves, base - leaves, {"signs": signs, "fail": fail, "keys": table, "nodes": nodes})
        for first, own in levels[1:]:
            parent, sign = np.divmod(own, width)
            fail[first : first + len(own)] = self.step(fail[parent], sign)
        return self, node - leaves

    def _shallow(self) -> None:
        """Whole rows of the transition table for the root and, if the alphabet is small enough, for its children."""
        row = np.zeros(self.width, dtype=np.int32)
        self.dense, self.deep = row[None, :], 0
        signs = np.arange(self.width, dtype=np.int64)
        child = self.goto(np.zeros(self.width, dtype=np.int64), signs)
        row[:] = np.where((signs > 0) & (child >= 0), child, 0)
        first = int(row.max())
        if first and first * int(self.width) <= DENSE and self.length > 1:
            state = np.repeat(np.arange(1, first + 1), self.width)
            child = self.goto(state, np.tile(signs, first)).reshape(first, -1)
            rows = np.where(child >= 0, child, row[None, :])
            rows[:, 0] = 0
            self.dense, self.deep = np.concatenate([row[None, :], rows]).astype(np.int32), first

    def arrays(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in self.ARRAYS}

    def goto(self, state: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The child of each node by each sign, -1 where there is none."""
        key = state * self.width + sign
        slot = ((key.view(np.uint64) * _ODD) >> self.shift).view(np.int64)
        found = self.keys[slot]
        out = np.where(found == key, self.nodes[slot], np.int32(-1))
        left = np.flatnonzero((found != key) & (found >= 0))
        slot, key = slot[left], key[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            found = self.keys[slot]
            hit = found == key
            out[left[hit]] = self.nodes[slot[hit]]
            more = ~hit & (found >= 0)
            left, slot, key = left[more], slot[more], key[more]
        return out

    def step(self, state: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The node after one more sign: goto, or goto of the nearest failure link that has one."""
        out = np.zeros(len(state), dtype=np.int32)
        state, sign = np.asarray(state, dtype=np.int64), np.asarray(sign, dtype=np.int64)
        deep = (state > self.deep) & (sign > 0)
        near = np.flatnonzero(~deep)
        out[near] = self.dense[np.minimum(state[near], self.deep), sign[near]]
        left = np.flatnonzero(deep)
        state, sign = state[left], sign[left]
        while len(left):
            child = self.goto(state, sign)
            hit = child >= 0
            out[left[hit]] = child[hit]
            rest = ~hit
            left, sign = left[rest], sign[rest]
            state = self.fail[state[rest]].astype(np.int64)
            near = state <= self.deep
            out[left[near]] = self.dense[state[near], sign[near]]
            deep = ~near
            left, sign, state = left[deep], sign[deep], state[deep]
        return out

    def found(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, pattern) for every pattern that a text holds, once and in this order."""
        places, patterns = self.scan(x, bounds)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[places] if len(places) else places
        key = np.sort(text * max(1, self.patterns) + patterns)
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        return np.divmod(key, max(1, self.patterns))

    def scan(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``x`` where a passage begins, its pattern) of all texts; no passage runs over the end of a text."""
        if not self.patterns:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        sizes = np.maximum(np.diff(bounds) - self.length + 1, 0)  # places where a passage can begin
        lanes = -(-sizes // LANE)
        first = np.cumsum(lanes) - lanes
        at = np.repeat(bounds[:-1], lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(first, lanes))
        end = np.minimum(at + LANE + self.length - 1, np.repeat(bounds[1:], lanes))
        order = np.argsort(at - end, kind="stable")  # long lanes first: those that end leave at the tail
        at, end = at[order], end[order]
        left = np.searchsorted(at - end, -np.arange(LANE + self.length), side="left")  # lanes longer than so many signs
        state = np.zeros(len(at), dtype=np.int32)
        places, patterns = [], []
        for i in range(LANE + self.length - 1):
            n = left[i]
            if not n:
                break
            state[:n] = self.step(state[:n], self.code[x[at[:n] + i]])
            hit = np.flatnonzero(state[:n] >= self.leaves)
            if len(hit):
                places.append(at[hit] + (i - self.length + 1))
                patterns.append(state[hit] - self.leaves)
                state[hit] = self.fail[state[hit]]  # a leaf has no child
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(patterns).astype(np.int64)

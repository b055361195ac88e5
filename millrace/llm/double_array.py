"""A trie of byte strings in a double array, built and walked with array operations.

A state is a slot. The child of slot s by byte b is slot ``base[s] + b`` if ``check`` there says s.
Building goes depth by depth over the sorted keys; then nodes with most children choose their base
first, all of one size at once: each tries a random base, those whose slots are free and claimed by
no other keep it, and the rest try again. Nodes with one child take the slots left over. Walking
moves the states of any number of strings by one byte at a time, all at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from millrace.llm.support import text_buffer

LOAD = 0.6
ROUNDS = 64


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    #: Number of the key that ends in a slot, or -1.
    value: np.ndarray
    keys: int

    def walk(self, states: np.ndarray, body: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The state of each string after ``lengths`` bytes of ``body`` from ``starts``; -1 where there is none."""
        states = np.array(states, np.int32)
        active = np.flatnonzero((states >= 0) & (lengths > 0))
        depth = 0
        while len(active):
            now = states[active]
            step = self.base[now] + body[starts[active] + depth]
            ok = self.check[step] == now
            states[active] = np.where(ok, step, -1)
            depth += 1
            active = active[ok & (lengths[active] > depth)]
        return states

    def after(self, text: bytes) -> int:
        """The state after one string from the root."""
        return int(self.walk(np.zeros(1, np.int32), np.frombuffer(text, np.uint8), np.zeros(1, np.int64), np.array([len(text)]))[0])

    def to_bytes(self) -> bytes:
        return np.array([len(self.base), self.keys], "<i8").tobytes() + b"".join(x.astype("<i4").tobytes() for x in (self.base, self.check, self.value))

    @classmethod
    def from_bytes(cls, data: bytes) -> DoubleArray:
        slots, keys = np.frombuffer(data, "<i8", 2).tolist()
        if len(data) != 16 + 12 * slots:
            raise ValueError("no whole double array")
        return cls(*(np.frombuffer(data, "<i4", slots, 16 + 4 * slots * i) for i in range(3)), keys)


def _nodes(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, byte) of every node but the root, which is node 0, by depth; and the node of each key."""
    lengths = np.diff(at)
    node = np.zeros(len(lengths), np.int64)
    parents, signs = [], []
    active, depth, count = np.arange(len(lengths)), 0, 1
    while True:
        active = active[lengths[active] > depth]
        if not len(active):
            break
        sign, parent = body[at[active] + depth], node[active]
        new = np.ones(len(active), bool)
        new[1:] = (sign[1:] != sign[:-1]) | (parent[1:] != parent[:-1])
        node[active] = count - 1 + np.cumsum(new)
        parents.append(parent[new])
        signs.append(sign[new])
        count += int(new.sum())
        depth += 1
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *parents]).astype(np.int64), np.concatenate([empty, *signs]).astype(np.int64), node


def build(keys: pa.Array) -> DoubleArray:
    """The trie of sorted, distinct, non-empty binary strings; key i has value i."""
    body, at = text_buffer(keys)
    parent, sign, node = _nodes(body, at)
    total = len(parent) + 1
    # Children stand together, as nodes are numbered by depth and then by key.
    order = np.argsort(parent, kind="stable")
    children = np.bincount(parent, minlength=total)
    first = np.concatenate(([0], np.cumsum(children)))[:-1]
    size = int(total / LOAD) + 1024
    used = np.zeros(size, bool)
    used[:257] = True  # the root, and no slot that a base below 1 would need
    base, slot = np.zeros(total, np.int64), np.zeros(total, np.int64)
    random = np.random.default_rng(0)
    for width in sorted(set(children[children > 1].tolist()), reverse=True):
        left, tries = np.flatnonzero(children == width), 0
        while len(left):
            tries += 1
            if tries % ROUNDS == 0:
                used = np.concatenate([used, np.zeros(len(used) // 2, bool)])
            chosen = random.integers(257, len(used) - 256, len(left))
            own = order[first[left][:, None] + np.arange(width)]
            wanted = chosen[:, None] + sign[own]
            free = np.flatnonzero(~used[wanted].any(1))
            claim = np.full(len(used), -1, np.int32) if len(free) * width > len(used) >> 6 else None
            if claim is not None:
                claim[wanted[free]] = free[:, None]
                won = free[(claim[wanted[free]] == free[:, None]).all(1)]
            else:
                flat = wanted[free].ravel()
                kept = np.zeros(len(flat), bool)
                kept[np.unique(flat, return_index=True)[1]] = True
                won = free[kept.reshape(-1, width).all(1)]
            base[left[won]] = chosen[won]
            slot[own[won].ravel() + 1] = wanted[won].ravel()
            used[wanted[won].ravel()] = True
            left = np.delete(left, won)
    single = np.flatnonzero(children == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(single):
        free = np.concatenate([free, np.arange(len(used), len(used) + len(single) - len(free))])
    only = order[first[single]]
    slot[only + 1] = free[: len(single)]
    base[single] = free[: len(single)] - sign[only]
    slots = max(len(used), int(slot.max()) + 1, int(base.max(initial=0)) + 256)
    out = DoubleArray(np.zeros(slots, np.int32), np.full(slots, -1, np.int32), np.full(slots, -1, np.int32), len(at) - 1)
    out.base[slot] = base
    out.check[slot[1:]] = slot[parent]
    out.value[slot[node]] = np.arange(len(node))
    return out

"""Double-array tries over sorted byte strings, built and walked with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTES = 256


@dataclass
class Trie:
    """State ``s`` goes by byte ``b`` to ``base[s] + b`` if ``check`` there is ``s``; state 0 is nowhere.

    ``accepting`` has the state that each of the sorted strings ends in.
    """

    base: np.ndarray
    check: np.ndarray
    accepting: np.ndarray

    def numbers(self) -> np.ndarray:
        """For each state the place of its string among the sorted ones, or -1."""
        out = np.full(len(self.base), -1, np.int32)
        out[self.accepting] = np.arange(len(self.accepting))
        return out

    def step(self, states: np.ndarray, labels: np.ndarray | int) -> np.ndarray:
        there = self.base[states] + labels
        return np.where(self.check[there] == states, there, 0)

    def walk(self, states: np.ndarray, words: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """All states at once through their own words, byte by byte; those without a way end at 0."""
        out = states.copy()
        going = np.flatnonzero(states)
        at, end = starts[words[going]], starts[words[going] + 1]
        while len(going):
            more = at < end
            if not more.all():
                going, at, end = going[more], at[more], end[more]
            out[going] = after = self.step(out[going], data[at])
            alive = after > 0
            going, at, end = going[alive], at[alive] + 1, end[alive]
        return out


def build(data: np.ndarray, starts: np.ndarray, root: np.ndarray, roots: int) -> Trie:
    """The trie of distinct strings, sorted within roots that ascend; the roots are states 1 to ``roots``."""
    parent, label, node = _nodes(data, starts, root, roots)
    slot, base = _placed(parent, label, roots)
    size = int(slot.max(initial=0)) + 1 + _BYTES
    trie = Trie(np.zeros(size, np.int32), np.full(size, -1, np.int32), slot[node].astype(np.int32))
    trie.base[slot] = base
    trie.check[slot[roots:]] = slot[parent]
    return trie


def _nodes(data: np.ndarray, starts: np.ndarray, root: np.ndarray, roots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and label of every node below the roots, level by level, and the node each string ends in."""
    node = root.astype(np.int64)
    sizes = np.diff(starts)
    parents, labels, count, depth = [], [], roots, 0
    going = np.flatnonzero(sizes > 0)
    while len(going):
        symbol, above = data[starts[going] + depth], node[going]
        new = np.ones(len(going), bool)
        new[1:] = (above[1:] != above[:-1]) | (symbol[1:] != symbol[:-1])
        parents.append(above[new])
        labels.append(symbol[new])
        node[going] = count + np.cumsum(new) - 1
        count += int(new.sum())
        depth += 1
        going = going[sizes[going] > depth]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *parents]), np.concatenate([none, *labels]).astype(np.int64), node


def _placed(parent: np.ndarray, label: np.ndarray, roots: int) -> tuple[np.ndarray, np.ndarray]:
    """A slot for each node so that siblings lie at one base; nodes with many children are placed first.

    Bases are tried at random, many nodes at a time; of two that want a slot the first has it. Only children
    take what is left.
    """
    count = roots + len(parent)
    slot, base = np.zeros(count, np.int64), np.zeros(count, np.int64)
    slot[:roots] = np.arange(1, roots + 1)
    fan = np.bincount(parent, minlength=count)
    begin = np.concatenate([[0], np.cumsum(fan)])  # children lie together, in the order of their parents
    room = 1 + roots + len(parent) + len(parent) // 4 + 4 * _BYTES
    taken, claim = np.zeros(room, bool), np.zeros(room, np.int64)
    taken[: roots + 1] = True
    waiting = np.flatnonzero(fan > 1)
    waiting = waiting[np.argsort(-fan[waiting], kind="stable")]
    rng, failed = np.random.default_rng(0), 0
    while len(waiting):
        batch = waiting[: max(4096, len(waiting) // 8)]
        fans = fan[batch]
        bases = rng.integers(0, len(taken) - _BYTES, len(batch))
        owner = np.repeat(np.arange(len(batch)), fans)
        cuts = np.concatenate([[0], np.cumsum(fans)[:-1]])
        child = np.repeat(begin[batch] - cuts, fans) + np.arange(len(owner))
        want = bases[owner] + label[child]
        claim[want[::-1]] = owner[::-1]
        clash = np.logical_or.reduceat(taken[want] | (claim[want] != owner), cuts)
        good = ~clash[owner]
        slot[roots + child[good]] = want[good]
        taken[want[good]] = True
        base[batch[~clash]] = bases[~clash]
        waiting = np.concatenate([batch[clash], waiting[len(batch) :]])
        failed = failed + 1 if clash.all() else 0
        if failed > 20:  # too full for what is left: more room
            taken = np.concatenate([taken, np.zeros(len(taken) // 2, bool)])
            claim, failed = np.zeros(len(taken), np.int64), 0
    single = np.flatnonzero(fan == 1)
    free = np.flatnonzero(~taken)[: len(single)]
    child = begin[single]
    slot[roots + child] = free
    base[single] = free - label[child]
    return slot, base

"""Probabilistic automata inferred from examples by merging compatible prefix-tree states (ALERGIA).

Examples are read into a prefix tree with counts.  States are then merged in
order of their depth: a state joins the first settled one whose ending and next
symbols are as frequent, by Hoeffding's bound, along all continuations; else it
is settled itself.  What is left is a small automaton of the examples' format.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CODE = np.full(256, -1, dtype=np.int16)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
# Confidence of the compatibility test, and the weight of unseen symbols in a state.
ALPHA, UNSEEN = 0.05, 0.5


class State:
    __slots__ = ("passes", "ends", "moves", "counts")

    def __init__(self) -> None:
        self.passes, self.ends = 0, 0
        self.moves: dict[str, State] = {}
        self.counts: dict[str, int] = {}


def prefix_tree(examples: list[str]) -> State:
    root = State()
    for example in examples:
        state = root
        for c in example:
            state.passes += 1
            state.counts[c] = state.counts.get(c, 0) + 1
            state = state.moves.setdefault(c, State())
        state.passes += 1
        state.ends += 1
    return root


def _alike(f1: int, n1: int, f2: int, n2: int) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    return abs(f1 / n1 - f2 / n2) < bound


def compatible(a: State, b: State) -> bool:
    """Whether two states agree on endings and symbols, and so do the states that both lead to."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if not _alike(a.ends, a.passes, b.ends, b.passes):
            return False
        for c in a.counts.keys() | b.counts.keys():
            if not _alike(a.counts.get(c, 0), a.passes, b.counts.get(c, 0), b.passes):
                return False
            if c in a.moves and c in b.moves:
                todo.append((a.moves[c], b.moves[c]))
    return True


def _fold(into: State, tree: State) -> None:
    """Add a subtree's counts to a state; states that both lead to are folded alike."""
    todo = [(into, tree)]
    while todo:
        into, tree = todo.pop()
        into.passes += tree.passes
        into.ends += tree.ends
        for c, n in tree.counts.items():
            into.counts[c] = into.counts.get(c, 0) + n
            if c in into.moves:
                todo.append((into.moves[c], tree.moves[c]))
            else:
                into.moves[c] = tree.moves[c]


def infer(examples: list[str]) -> list[State]:
    """States of the merged automaton; the first one is the start."""
    root = prefix_tree(examples)
    settled, fringe = [root], deque((root, c) for c in sorted(root.moves))
    known = {id(root)}
    while fringe:
        parent, c = fringe.popleft()
        state = parent.moves[c]
        if id(state) in known:
            continue
        match = next((s for s in settled if compatible(s, state)), None)
        if match is None:
            settled.append(state)
            known.add(id(state))
            fringe += [(state, x) for x in sorted(state.moves)]
        else:
            parent.moves[c] = match
            before = set(match.moves)
            _fold(match, state)
            # Subtrees that folding hung under settled states are looked at in their turn.
            fringe += [(s, x) for s in settled for x in sorted(s.moves)
                       if id(s.moves[x]) not in known and (s is match and x not in before or s is not match)]
    return settled


class Automata:
    """Several automata as one table; a symbol that a state never saw keeps the state."""

    def __init__(self, inferred: list[list[State]]) -> None:
        total = sum(map(len, inferred))
        self.moves = np.tile(np.arange(total, dtype=np.int32)[:, None], (1, len(ALPHABET)))
        self.logs = np.empty((total, len(ALPHABET)))
        self.end_logs = np.empty(total)
        self.starts, base = [], 0
        for states in inferred:
            number = {id(s): base + k for k, s in enumerate(states)}
            self.starts.append(base)
            for s in states:
                k, weight = number[id(s)], s.passes + UNSEEN
                share = UNSEEN / (len(ALPHABET) + 1)
                self.logs[k] = math.log(share / weight)
                self.end_logs[k] = math.log((s.ends + share) / weight)
                for c, n in s.counts.items():
                    at = ALPHABET.index(c)
                    self.logs[k, at] = math.log((n + share) / weight)
                    self.moves[k, at] = number[id(s.moves[c])]
            base += len(states)

    def likelihoods(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of every text (over ALPHABET, not empty) in every automaton: one row a text."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        codes = CODE[np.frombuffer("".join(texts).encode("ascii"), dtype=np.uint8)].astype(np.int64)
        starts = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        states = np.tile(np.array(self.starts, dtype=np.int32), (len(texts), 1))
        sums = np.zeros((len(texts), len(self.starts)))
        active, j = len(texts), 0
        # All texts symbol by symbol while many are that long; the few longest one by one.
        while active >= 16:
            symbols = codes[starts[:active] + j, None]
            sums[:active] += self.logs[states[:active], symbols]
            states[:active] = self.moves[states[:active], symbols]
            j += 1
            active = int(np.searchsorted(-lengths, -j))
        moves, logs = (self.moves.tolist(), self.logs.tolist()) if active else ([], [])
        for t in range(active):
            rest = codes[starts[t] + j:starts[t] + lengths[t]].tolist()
            for k in range(len(self.starts)):
                state, total = int(states[t, k]), float(sums[t, k])
                for symbol in rest:
                    total += logs[state][symbol]
                    state = moves[state][symbol]
                states[t, k], sums[t, k] = state, total
        out = np.empty_like(sums)
        out[order] = sums + self.end_logs[states]
        return out

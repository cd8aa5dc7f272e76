"""Probabilistic automata of string formats, inferred by merging prefix-tree states."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable

# Significance of the test that keeps two states apart.
ALPHA = 0.05
# Score of a character that the automaton has never seen in its state.
UNSEEN = math.log(1e-4)


class Automaton:
    """States with counted character transitions and ends; a deterministic one from ``infer``."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.count: list[dict[int, int]] = [{}]
        self.ends: list[int] = [0]
        self.visits: list[int] = [0]

    def _state(self) -> int:
        self.next.append({})
        self.count.append({})
        self.ends.append(0)
        self.visits.append(0)
        return len(self.next) - 1

    def add(self, value: bytes) -> None:
        state = 0
        self.visits[0] += 1
        for c in value:
            onward = self.next[state].get(c)
            if onward is None:
                onward = self.next[state][c] = self._state()
            self.count[state][c] = self.count[state].get(c, 0) + 1
            self.visits[onward] += 1
            state = onward
        self.ends[state] += 1

    def tables(self) -> list[dict[int, tuple[float, int]]]:
        """Per state: character to (log probability, next state); -1 stands for the end.

        Counts are smoothed a little, so a state seen once does not claim certainty.
        """
        out = []
        for state in range(len(self.next)):
            total = self.visits[state] + 1.0
            table = {c: (math.log(n / total), self.next[state][c]) for c, n in self.count[state].items()}
            table[-1] = (math.log((self.ends[state] + 0.01) / total), state)
            out.append(table)
        return out


def _apart(n1: int, m1: int, n2: int, m2: int, alpha: float) -> bool:
    """Hoeffding test: do n1 of m1 and n2 of m2 differ?"""
    if not m1 or not m2:
        return False
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(m1) + 1 / math.sqrt(m2))
    return abs(n1 / m1 - n2 / m2) > bound


def infer(values: Iterable[bytes], alpha: float = ALPHA) -> Automaton:
    """Prefix tree of ``values``, its compatible states merged red to blue in breadth-first order.

    Two states are compatible if their end and character frequencies, and those of all
    states that a merge would identify, pass the Hoeffding test. The order of the values
    does not matter.
    """
    tree = Automaton()
    for value in sorted(values):
        tree.add(value)

    def compatible(red: int, blue: int) -> bool:
        waiting = [(red, blue)]
        while waiting:
            a, b = waiting.pop()
            if _apart(tree.ends[a], tree.visits[a], tree.ends[b], tree.visits[b], alpha):
                return False
            for c in tree.count[a].keys() | tree.count[b].keys():
                n, m = tree.count[a].get(c, 0), tree.count[b].get(c, 0)
                if _apart(n, tree.visits[a], m, tree.visits[b], alpha):
                    return False
                if n and m:
                    waiting.append((tree.next[a][c], tree.next[b][c]))
        return True

    def distance(red: int, blue: int) -> float:
        """Between the character and end frequencies of two states."""
        m, n = max(tree.visits[red], 1), max(tree.visits[blue], 1)
        both = tree.count[red].keys() | tree.count[blue].keys()
        apart = sum(abs(tree.count[red].get(c, 0) / m - tree.count[blue].get(c, 0) / n) for c in both)
        return apart + abs(tree.ends[red] / m - tree.ends[blue] / n)

    red, known = [0], {0}
    blue = deque((0, c) for c in sorted(tree.next[0]))

    def fold(red_state: int, blue_state: int) -> None:
        """Adds the subtree of a blue state into a red one."""
        waiting = [(red_state, blue_state)]
        while waiting:
            a, b = waiting.pop()
            tree.ends[a] += tree.ends[b]
            tree.visits[a] += tree.visits[b]
            for c, n in sorted(tree.count[b].items()):
                if c in tree.count[a]:
                    tree.count[a][c] += n
                    waiting.append((tree.next[a][c], tree.next[b][c]))
                else:
                    tree.count[a][c] = n
                    tree.next[a][c] = tree.next[b][c]
                    if a in known:
                        blue.append((a, c))

    while blue:
        parent, c = blue.popleft()
        state = tree.next[parent][c]
        if state in known:
            continue
        # Rarely seen states are compatible with many; the most alike one takes them.
        for r in sorted(red, key=lambda r: (distance(r, state), r)):
            if compatible(r, state):
                tree.next[parent][c] = r
                fold(r, state)
                break
        else:
            red.append(state)
            known.add(state)
            blue.extend((state, x) for x in sorted(tree.next[state]))
    return _reachable(tree)


def _reachable(tree: Automaton) -> Automaton:
    names, order = {0: 0}, [0]
    for state in order:
        for _, onward in sorted(tree.next[state].items()):
            if onward not in names:
                names[onward] = len(order)
                order.append(onward)
    out = Automaton()
    out.next = [{c: names[s] for c, s in tree.next[state].items()} for state in order]
    out.count = [dict(tree.count[state]) for state in order]
    out.ends = [tree.ends[state] for state in order]
    out.visits = [tree.visits[state] for state in order]
    return out


def likelihood(tables: list[dict[int, tuple[float, int]]], value: bytes) -> tuple[float, float]:
    """(log probability per character, share of unseen characters).

    An unseen character costs ``UNSEEN`` and stays in its state.
    """
    total, state, unseen = 0.0, 0, 0
    for c in value:
        step = tables[state].get(c)
        if step is None:
            total += UNSEEN
            unseen += 1
        else:
            total += step[0]
            state = step[1]
    return (total + tables[state][-1][0]) / (len(value) + 1), unseen / max(1, len(value))

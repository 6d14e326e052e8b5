"""Weighted acyclic automata over words: minimal, built from sorted keys, united with summed weights, composed for lookups.

A state has a weight (0: no key ends here) and arcs by word to other states. States with equal weight and equal arcs are one state, so the
automaton is the smallest one that gives each key its weight at the state where it ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

Key = tuple[str, ...]


class Automaton:
    """States in the order in which they were closed, so that arcs only go to earlier ones; the last state is the first of every path."""

    def __init__(self, weights: list[int], arcs: list[dict[str, int]]) -> None:
        self.weights, self.arcs = weights, arcs

    def items(self) -> Iterator[tuple[Key, int]]:
        """Keys and weights, in order of the keys."""
        path: list[str] = []
        open_arcs = [iter(self.arcs[-1].items())]
        if self.weights[-1]:
            yield (), self.weights[-1]
        while open_arcs:
            step = next(open_arcs[-1], None)
            if step is None:
                open_arcs.pop()
                del path[-1:]
                continue
            path.append(step[0])
            if self.weights[step[1]]:
                yield tuple(path), self.weights[step[1]]
            open_arcs.append(iter(self.arcs[step[1]].items()))

    def weight(self, key: Key) -> int:
        state = len(self.arcs) - 1
        for word in key:
            state = self.arcs[state].get(word, -1)
            if state < 0:
                return 0
        return self.weights[state]

    def to_bytes(self) -> bytes:
        return json.dumps([self.weights, self.arcs], ensure_ascii=False, separators=(",", ":")).encode()

    @staticmethod
    def from_bytes(data: bytes) -> Automaton:
        return Automaton(*json.loads(data))


class Builder:
    """Adds keys in ascending order. States that the next key can't reach any more are closed at once, and looked up among the closed ones."""

    def __init__(self) -> None:
        self.weights: list[int] = []
        self.arcs: list[dict[str, int]] = []
        self.closed: dict[tuple | int, int] = {}
        self.open: list[tuple[list[int], dict[str, int]]] = [([0], {})]
        self.last: list[str] = []

    def add(self, key: Key, weight: int) -> None:
        """A key that is added twice in a row has the sum of its weights."""
        last, shared = self.last, 0
        for word in key:
            if shared == len(last) or last[shared] != word:
                break
            shared += 1
        if shared < len(last):
            if shared == len(key) or key[shared] < last[shared]:
                raise ValueError("keys must be added in ascending order")
            self._close(shared)
        for word in key[shared:]:
            last.append(word)
            self.open.append(([0], {}))
        self.open[-1][0][0] += weight

    def _close(self, depth: int) -> None:
        while len(self.last) > depth:
            (weight,), arcs = self.open.pop()
            self.open[-1][1][self.last.pop()] = self._number(weight, arcs)

    def _number(self, weight: int, arcs: dict[str, int]) -> int:
        state = (weight, *arcs.items()) if arcs else weight
        found = self.closed.get(state)
        if found is None:
            found = self.closed[state] = len(self.arcs)
            self.weights.append(weight)
            self.arcs.append(arcs)
        return found

    def finish(self) -> Automaton:
        """No key goes back to the first state, so it is always a state of its own and the last one."""
        self._close(0)
        (weight,), arcs = self.open.pop()
        self.weights.append(weight)
        self.arcs.append(arcs)
        return Automaton(self.weights, self.arcs)


def build(items: Iterable[tuple[Key, int]]) -> Automaton:
    builder = Builder()
    for key, weight in items:
        builder.add(key, weight)
    return builder.finish()


def union(automata: list[Automaton], least: int = 0) -> Automaton:
    """All keys of all automata with the sums of their weights. States that a word leads to are walked together.

    With `least`, keys with a smaller sum are left out, and so is all that begins with them: a key must weigh at least as much as any longer one.
    """
    builder = Builder()

    def walk(states: list[tuple[list[int], list[dict[str, int]], int]], first: bool) -> int | None:
        weight = 0
        for weights, _, state in states:
            weight += weights[state]
        if 0 < weight < least:
            return None
        meeting: dict[str, list] = {}
        for weights, arcs, state in states:
            for word, to in arcs[state].items():
                found = meeting.get(word)
                if found is None:
                    meeting[word] = [(weights, arcs, to)]
                else:
                    found.append((weights, arcs, to))
        out = {}
        for word in sorted(meeting):
            number = walk(meeting[word], False)
            if number is not None:
                out[word] = number
        if first:
            builder.weights.append(weight)
            builder.arcs.append(out)
            return None
        return builder._number(weight, out) if weight or out else None

    walk([(a.weights, a.arcs, len(a.arcs) - 1) for a in automata], True)
    return Automaton(builder.weights, builder.arcs)


def compose(keys: Automaton, weights: Automaton) -> Automaton:
    """The keys that both automata have, with the weights of the second. Both are walked at once, along the arcs that both have."""
    builder, path = Builder(), []

    def walk(a: int, b: int) -> None:
        if keys.weights[a] and weights.weights[b]:
            builder.add(tuple(path), weights.weights[b])
        arcs = weights.arcs[b]
        for word, state in keys.arcs[a].items():
            if word in arcs:
                path.append(word)
                walk(state, arcs[word])
                path.pop()

    walk(len(keys.arcs) - 1, len(weights.arcs) - 1)
    return builder.finish()

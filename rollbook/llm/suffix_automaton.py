"""A generalised suffix automaton of a fixed set of patterns, for streaming matching statistics.

A state stands for the substrings of patterns that end at the same places; `length` is its longest one. While a
sequence is streamed, (state, matched) always describe the longest suffix read so far that occurs in a pattern.
A whole pattern is the longest string of its state: its own occurrence has nothing to its left. So the patterns that
end at the current place are those of the states on the suffix links.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    def __init__(self, patterns: Iterable[tuple[Sequence[Hashable], object]]):
        """Patterns as (sequence, value). Of equal sequences the last value holds; empty ones are left out."""
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        patterns = [(s, v) for s, v in patterns if len(s)]
        for sequence, _ in patterns:
            state = 0
            for symbol in sequence:
                state = self._add(state, symbol)
        self.value: dict[int, object] = {}
        for sequence, value in patterns:
            state = 0
            for symbol in sequence:
                state = self.next[state][symbol]
            self.value[state] = value
        self._ends: dict[int, tuple] = {}
        self._nodes: dict[tuple[int, int], list] = {}
        # the nearest state with a pattern: the state itself, or else the next on its links
        self.nearest = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest[state] = state if state in self.value else self.nearest[self.link[state]]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, symbol: Hashable, target: int) -> int:
        """A copy of `target` for the strings no longer than those that reach it from `state`."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _add(self, last: int, symbol: Hashable) -> int:
        if symbol in self.next[last]:
            target = self.next[last][symbol]
            return target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and symbol not in self.next[state]:
            self.next[state][symbol] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][symbol]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, symbol, target)
        return new

    def step(self, state: int, matched: int, symbol: Hashable) -> tuple[int, int]:
        while symbol not in self.next[state]:
            if state == 0:
                return 0, 0
            state = self.link[state]
            matched = self.length[state]
        return self.next[state][symbol], matched + 1

    def ending(self, state: int, matched: int) -> tuple[tuple[int, object], ...]:
        """(length, value) of all patterns that end here, longest first."""
        return self.ends(state if matched == self.length[state] else self.link[state]) if state else ()

    def ends(self, state: int) -> tuple[tuple[int, object], ...]:
        """(length, value) of all patterns that are suffixes of the state's longest string, longest first."""
        known = self._ends.get(state)
        if known is None:
            found, at = [], self.nearest[state]
            while at > 0:
                found.append((self.length[at], self.value[at]))
                at = self.nearest[self.link[at]]
            known = self._ends[state] = tuple(found)
        return known

    def walk_step(self, node: list, symbol: Hashable) -> list:
        """`step` and `ending` on nodes that remember what they found, for many sequences over the same patterns. A node is
        (edges known so far, patterns that end here, state, matched); `walk_start` is the first."""
        state, matched = self.step(node[2], node[3], symbol)
        known = self._nodes.get((state, matched))
        if known is None:
            known = self._nodes[state, matched] = [{}, self.ending(state, matched), state, matched]
        node[0][symbol] = known
        return known

    @property
    def walk_start(self) -> list:
        return self._nodes.setdefault((0, 0), [{}, (), 0, 0])

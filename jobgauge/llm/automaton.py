"""Generalised suffix automaton over sequences of integers."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator


class SuffixAutomaton:
    """All substrings of the added sequences. State 0 is the empty string; `link` is the longest suffix in another state.

    Each state stands for the substrings that end at the same places, of the lengths `length[link] + 1` to `length`.
    """

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def add(self, sequence: Iterable[Hashable]) -> list[int]:
        """Add a sequence; the states of its prefixes, in order, without the empty one."""
        last, states = 0, []
        for symbol in sequence:
            last = self._extend(last, symbol)
            states.append(last)
        return states

    def _extend(self, last: int, symbol: Hashable) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            # The prefix is a substring of an earlier sequence already.
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, symbol, known)
        new = self._state({}, self.length[last] + 1, 0)
        state = last
        while state != -1 and symbol not in self.next[state]:
            self.next[state][symbol] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][symbol]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._clone(state, symbol, target)
        return new

    def _clone(self, state: int, symbol: Hashable, target: int) -> int:
        """Split the shorter substrings of `target`, those that end here too, off into a state of their own."""
        clone = self._state(dict(self.next[target]), self.length[state] + 1, self.link[target])
        self.link[target] = clone
        while state != -1 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def _state(self, edges: dict[Hashable, int], length: int, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def longest_first(self) -> list[int]:
        """All states but the empty one, longest substrings first, so that links come after what links to them."""
        return sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)

    def matching(self, sequence: Iterable[Hashable]) -> Iterator[tuple[int, int]]:
        """For each position the state and length of the longest substring that ends there and is in the automaton."""
        state = matched = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            yield state, matched

    def add_matching(self, sequence: Iterable[Hashable]) -> Iterator[int]:
        """Add a sequence; for each position the length of the longest substring that ends there and also ended earlier."""
        state = matched = last = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            yield matched
            last = self._extend(last, symbol)
            while state and self.length[self.link[state]] >= matched:  # the matched substring may have been split off
                state = self.link[state]

    def suffix_of(self, state: int, length: int) -> int:
        """The state of the suffix of `length` of what ends in `state`."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

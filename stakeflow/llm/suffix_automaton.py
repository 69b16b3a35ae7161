"""Suffix automaton over word sequences, with matching statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added so far (a generalised automaton, grown online)."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.len: list[int] = [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A state for the longest string that reaches ``q`` from ``p`` by ``word``."""
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: Sequence) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # the string is known already
                last = q if self.len[q] == self.len[last] + 1 else self._split(last, word, q)
                continue
            new = self._state(self.len[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, word, q)
            last = new

    def match(self, words: Sequence) -> Iterator[tuple[int, int]]:
        """For each end in ``words``: (state, length) of the longest match that ends there."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length

    def windows(self, words: Sequence, size: int) -> Iterator[tuple[int, int]]:
        """(start, state) of every window of ``size`` words that occurs; a state stands for
        exactly one window of that size."""
        for end, (state, length) in enumerate(self.match(words)):
            if length >= size:
                while self.len[self.link[state]] >= size:
                    state = self.link[state]
                yield end + 1 - size, state

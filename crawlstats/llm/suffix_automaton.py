"""A suffix automaton over words, with weighted occurrence counts."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """All substrings of the added texts; a text added with weight n occurs n times."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state of the shorter substrings of q, which p reaches by ``word``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word) -> int:
        q = self.next[last].get(word)
        if q is not None:  # known from an earlier text
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def add(self, text: Sequence, weight: int = 1) -> None:
        last = 0
        for word in text:
            last = self._extend(last, word)
            self.count[last] += weight

    def finish(self) -> SuffixAutomaton:
        """Sums the occurrences up; call once, after the last text."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]
        return self

    def windows(self, text: Sequence, size: int) -> list[int]:
        """Matching statistics of ``text``: for each window of ``size`` words, how often it occurs."""
        out, s, matched = [], 0, 0
        for i, word in enumerate(text):
            while s and word not in self.next[s]:
                s = self.link[s]
                matched = self.length[s]
            if word in self.next[s]:
                s, matched = self.next[s][word], matched + 1
            while s and self.length[self.link[s]] >= size:
                s = self.link[s]
                matched = self.length[s]
            if i >= size - 1:
                out.append(self.count[s] if matched >= size else 0)
        return out

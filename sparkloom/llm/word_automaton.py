"""Suffix automaton over sequences of word ids.

One class serves single texts and collections (a generalised automaton: every text starts at the root again).
Each state has a transition dict, a suffix link, the length of its longest string and the number of places at
which its strings end.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.len: list[int] = [0]
        self.ends: list[int] = [0]

    def add(self, words: Sequence, weight: int = 1) -> list[int]:
        """Adds a text that occurs weight times. Returns the state of each of its prefixes."""
        nxt, link, length, ends = self.next, self.link, self.len, self.ends
        last, at = 0, []
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                if length[q] == length[last] + 1:
                    last = q
                else:
                    last = self._clone(last, word, q)
            else:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                ends.append(0)
                link.append(0)
                p = last
                while p >= 0 and word not in nxt[p]:
                    nxt[p][word] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][word]
                    link[cur] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
                last = cur
            ends[last] += weight
            at.append(last)
        return at

    def _clone(self, p: int, word: object, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.ends.append(0)
        link[q] = copy
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def count_ends(self) -> None:
        """Call once after the last add: ends then counts all places where a state's strings end."""
        length, link, ends = self.len, self.link, self.ends
        for v in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            if link[v] > 0:
                ends[link[v]] += ends[v]

    def stream(self, words: Iterable) -> tuple[list[int], list[int]]:
        """Matching statistics: at each word the state and the length of the longest match that ends there."""
        nxt, link, length = self.next, self.link, self.len
        state = matched = 0
        states, lengths = [], []
        for word in words:
            to = nxt[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(word)
            if to is None:
                matched = 0
            else:
                state = to
                matched += 1
            states.append(state)
            lengths.append(matched)
        return states, lengths

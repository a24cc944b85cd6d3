"""A suffix automaton over numbered words, grown document by document and streamed for matching statistics."""

from __future__ import annotations


class SuffixAutomaton:
    """States are numbers; `length`, `link` and `next` are the usual arrays of the online construction."""

    __slots__ = ("last", "length", "link", "next")

    def __init__(self) -> None:
        self.length, self.link, self.next, self.last = [0], [-1], [{}], 0

    def add(self, words: list[int]) -> None:
        """Append a text; a separator that equals no word keeps matches from running across texts."""
        length, link, nxt = self.length, self.link, self.next
        # starting again from the root makes a generalised automaton: no separator symbol is stored
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                if length[q] == length[last] + 1:
                    last = q
                    continue
                clone = len(length)
                length.append(length[last] + 1)
                link.append(link[q])
                nxt.append(nxt[q].copy())
                link[q] = clone
                p = last
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
                last = clone
                continue
            cur = len(length)
            length.append(length[last] + 1)
            link.append(0)
            nxt.append({})
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    nxt.append(nxt[q].copy())
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.last = last

    def statistics(self, words: list[int]) -> list[int]:
        """For each place, the length of the longest run ending there that some added text holds."""
        length, link, nxt = self.length, self.link, self.next
        state, n, out = 0, 0, []
        for w in words:
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(w)
            if to is not None:
                state, n = to, n + 1
            else:
                n = 0
            out.append(n)
        return out

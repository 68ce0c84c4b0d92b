"""Token counts by linear longest match (operator 8).

Greedy word-piece lengths without building pieces: a trie over the
word-initial pieces and one over the continuing pieces, with failure links and
the number of pieces that following a link pops, both worked out once
(LinMaxMatch). A word is read once, byte by byte: where the trie has no step,
the link's count is added and its node taken, so no byte is read twice.

The vocabulary comes from a public byte-level file: tokens with a leading
space are word-initial pieces, all others continue a word. Words are what
stands between ASCII white space. A word that the pieces cannot cover is one
unknown token.

A task remembers the counts of ``MEMO`` words at most.

Nulls: a null text is empty: no words, no tokens.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.rows import map_texts

MEMO = 500_000
#: Count of a word that the pieces cannot cover.
UNKNOWN = -1


def vocabulary(path: str) -> tuple[set[bytes], set[bytes]]:
    """Word-initial and continuing pieces of a file of base64 tokens with ranks."""
    with open(path, "rb") as lines:
        tokens = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return {t[1:] for t in tokens if t[:1] == b" " and len(t) > 1 and b" " not in t[1:]}, {t for t in tokens if t and b" " not in t}


class LongestMatch:
    """Trie with failure links; ``pops[v]`` tokens leave when the link of ``v`` is taken."""

    START, INSIDE = 0, 1

    def __init__(self, initial: Iterable[bytes], inside: Iterable[bytes]):
        self.step: dict[int, int] = {}  # node << 8 | byte
        self.nodes = 2
        whole = {self._add(self.START, p) for p in initial} | {self._add(self.INSIDE, p) for p in inside}
        self._links(whole)

    def _add(self, node: int, piece: bytes) -> int:
        for c in piece:
            key = node << 8 | c
            if key not in self.step:
                self.step[key] = self.nodes
                self.nodes += 1
            node = self.step[key]
        return node

    def _links(self, whole: set[int]) -> None:
        self.fail = [-1] * self.nodes
        self.pops = [0] * self.nodes
        children: dict[int, list[tuple[int, int]]] = {}
        for key, v in self.step.items():
            children.setdefault(key >> 8, []).append((key & 255, v))
        queue = deque([self.START, self.INSIDE])
        while queue:
            u = queue.popleft()
            for c, v in children.get(u, ()):
                queue.append(v)
                if v in whole:
                    self.fail[v], self.pops[v] = self.INSIDE, 1
                    continue
                z, popped = self.fail[u], self.pops[u]
                while z != -1 and (z << 8 | c) not in self.step:
                    popped += self.pops[z]
                    z = self.fail[z]
                if z != -1:
                    self.fail[v], self.pops[v] = self.step[z << 8 | c], popped

    def count(self, word: bytes) -> int:
        """Number of greedy pieces of the word, or ``UNKNOWN``."""
        step, fail, pops = self.step, self.fail, self.pops
        node = n = 0
        for c in word:
            while (key := node << 8 | c) not in step:
                if fail[node] == -1:
                    return UNKNOWN
                n += pops[node]
                node = fail[node]
            node = step[key]
        while node != self.INSIDE:
            if fail[node] == -1:
                return UNKNOWN if word else 0
            n += pops[node]
            node = fail[node]
        return n


class _Memo(dict):
    """Counts of words seen before; starts anew when it is full."""

    def __init__(self, automaton: LongestMatch):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self[word] = self.automaton.count(word)
        return n


def counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, words, tokens (an unknown word is one), and unknown words of every row."""

    def make() -> Callable:
        memo = _Memo(LongestMatch(*vocabulary(path)))

        def one(t: bytes | None) -> tuple:
            words = t.split() if t else []
            each = list(map(memo.__getitem__, words))
            unknown = each.count(UNKNOWN)
            return len(words), sum(each) + 2 * unknown, unknown

        return one

    long = T.LongType()
    return map_texts(docs, make, [("n_words", long), ("n_tokens", long), ("n_unknown", long)], keys=(key,), text=text)

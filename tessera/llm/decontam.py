"""Benchmark decontamination (operator 3).

A generalised suffix automaton of the items' words is streamed over each
text's words. At every word the automaton gives the longest suffix of the text
so far that is a substring of some item; where that reaches a window (13
words, or a whole shorter item), the window's words are hit and its items
found. Texts enter the automaton only where their words can be part of a
window: runs of words whose every adjacent pair is adjacent in some item. A
window is such a run, so nothing is lost.

Items are broadcast in blocks of at most ``BLOCK_WORDS`` words; further blocks
make further passes, so the memory of a task has a bound at any number of items.

Nulls: a null text has no words: not contaminated, no items. Items with null
id or no words take no part. Repeated items count once by id. An empty
``items`` table: no hits. Bytes that are no UTF-8 belong to words, as letters
beyond ASCII do; in a text that is cut they become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rows import alnum_words, decoded, map_texts, numbered, utf8

WINDOW = 13
#: Words of items in one automaton: about 100 MB in a task.
BLOCK_WORDS = 200_000
#: A kept document keeps hit spans up to this length, such as quotations; longer ones are cut out.
SPAN_WORDS = 50
_HASHED = 1 << 22


class ItemAutomaton:
    """Generalised suffix automaton over word ids, with the windows each state completes."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        sequences = []
        for name, words in items:
            if words:
                sequences.append((name, [self.vocab.setdefault(w, len(self.vocab)) for w in words]))
        for _, seq in sequences:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.least = min((min(window, len(s)) for _, s in sequences), default=0)
        self._windows(sequences)
        self._pairs(sequences)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        made = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = made
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = made
            p = link[p]
        return made

    def _windows(self, sequences) -> None:
        """full: state to items that hold its window-long suffix; short: state to (length, items) of whole shorter items."""
        self.full: dict[int, set[str]] = {}
        ends: dict[int, dict[int, set[str]]] = {}
        for name, seq in sequences:
            state = 0
            for i, c in enumerate(seq):
                state = self.next[state][c]
                if len(seq) >= self.window and i + 1 >= self.window:
                    s = state
                    while self.len[self.link[s]] >= self.window:
                        s = self.link[s]
                    self.full.setdefault(s, set()).add(name)
            if len(seq) < self.window:
                s = state
                while self.link[s] != -1 and self.len[self.link[s]] >= len(seq):
                    s = self.link[s]
                ends.setdefault(s, {}).setdefault(len(seq), set()).add(name)
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.short: list[tuple] = [()] * len(order)
        self.at: list[int] = [0] * len(order)  # the state that holds the window-long suffix
        for s in order[1:]:
            up = self.link[s]
            own = tuple((n, frozenset(x)) for n, x in ends.get(s, {}).items())
            self.short[s] = self.short[up] + own if own else self.short[up]
            self.at[s] = self.at[up] if self.len[up] >= self.window else s

    def _pairs(self, sequences) -> None:
        self.hashed = np.zeros(_HASHED, dtype=bool)
        for _, seq in sequences:
            x = np.array(seq, dtype=np.int64)
            self.hashed[self._slot(x[:-1], x[1:])] = True

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b) & (_HASHED - 1)

    def runs(self, words: list[bytes]) -> list[tuple[int, int, list[int]]]:
        """Runs of words that can hold a window: start, end, word ids."""
        if not self.least or len(words) < self.least:
            return []
        ids = np.fromiter(map(self.vocab.get, words, _minus_one()), dtype=np.int64, count=len(words))
        known = ids >= 0
        tied = known[:-1] & known[1:] & self.hashed[self._slot(ids[:-1], ids[1:])]
        breaks = np.flatnonzero(~tied) + 1
        starts = np.concatenate([[0], breaks])
        ends = np.concatenate([breaks, [len(ids)]])
        long = (ends - starts >= self.least) & known[starts]
        return [(s, e, ids[s:e].tolist()) for s, e in zip(starts[long].tolist(), ends[long].tolist())]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        nxt, link, length, w = self.next, self.link, self.len, self.window
        for start, _, ids in self.runs(words):
            state = matched = 0
            for i, c in enumerate(ids, start):
                while state and c not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if c in nxt[state]:
                    state = nxt[state][c]
                    matched += 1
                else:
                    continue
                most = 0
                if matched >= w:
                    most = w
                    found |= self.full.get(self.at[state], frozenset())
                for n, names in self.short[state]:
                    if n <= matched:
                        most = max(most, n)
                        found |= names
                if most:
                    a, b = i + 1 - most, i + 1
                    if spans and a <= spans[-1][1]:
                        while len(spans) > 1 and a <= spans[-2][1]:
                            spans.pop()
                        spans[-1] = (min(a, spans[-1][0]), b)
                    else:
                        spans.append((a, b))
        return spans, found


def _minus_one():
    while True:
        yield -1


def _blocks(items: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size; one block is held at a time. At least one block, which may be empty."""
    block: list[tuple[str, bytes]] = []
    size = 0
    plain = items.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("i is not null and t is not null").distinct()
    for r in plain.toLocalIterator():
        n = len(r["t"]) // 4
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"].encode()))
        size += n
    yield block


def _broadcasts(items: DataFrame) -> list[Broadcast]:
    """A broadcast for each block; Spark keeps them on disk, so the driver's memory does not grow with the items."""
    context = items.sparkSession.sparkContext
    return [context.broadcast(b) for b in _blocks(items)]


def _pass(docs: DataFrame, held: Broadcast, window: int) -> DataFrame:
    def make() -> Callable:
        automaton = ItemAutomaton([(i, alnum_words(t)) for i, t in held.value], window)

        def one(text: bytes | None) -> tuple:
            words = alnum_words(text)
            spans, found = automaton.scan(words)
            return len(words), [{"s": a, "e": b} for a, b in spans], sorted(found)

        return one

    span = T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])
    return map_texts(docs, make, [("n_words", T.LongType()), ("spans", T.ArrayType(span)), ("items", T.ArrayType(T.StringType()))])


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, hit spans (word positions, end exclusive, merged) and items of every document.

    One block of items, the usual case, is one pass without a shuffle. With
    more, each pass is keyed by the text's hash beside doc_id and the passes
    are joined on both; distinct first, as the result depends on the text alone.
    """
    blocks = _broadcasts(items)
    if len(blocks) == 1:
        return _pass(docs, blocks[0], window)
    key = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    texts = docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("doc_id"), "text").groupBy("doc_id").agg(F.first("text").alias("text"))
    parts = [_pass(texts, b, window) for b in blocks]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    merged = whole.groupBy(F.col("doc_id").alias("h")).agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return key.join(merged, "h", "left").drop("h")


def judged(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Counts, digest of the items, and whether a twentieth or more of the words are hit."""
    return _judge(matches(docs, items, window))


def _counted(found: DataFrame) -> DataFrame:
    hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["s"], x["e"] - 1))))).cast("long")
    return found.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def _judge(found: DataFrame) -> DataFrame:
    return _counted(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def cleaned(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = SPAN_WORDS) -> DataFrame:
    """The documents that are not contaminated, without their hit spans of more than ``most`` words; the same columns.

    With one block of items this is done row by row, without a join; with
    more, rows find their spans through their text's hash. ``n_chars``, where
    there is one, follows a new text.
    """
    blocks = _broadcasts(items)
    plain, at = numbered(docs)
    text = F.col(at["text"])
    if len(blocks) == 1:
        held = blocks[0]

        @F.arrow_udf("bad boolean, text string")
        def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            automaton = ItemAutomaton([(i, alnum_words(t)) for i, t in held.value], window)
            for texts in batches:
                bad, new = [], []
                for t in utf8(texts):
                    words = alnum_words(t)
                    spans = automaton.scan(words)[0]
                    hit = sum(b - a for a, b in spans)
                    bad.append(hit > 0 and 20 * hit >= len(words))
                    long = not bad[-1] and any(b - a > most for a, b in spans)
                    new.append(without_spans(decoded(t), spans, most) if long else None)
                yield pa.StructArray.from_arrays([pa.array(bad, type=pa.bool_()), pa.array(new, type=pa.string())], names=["bad", "text"])

        # Not deterministic for Spark, so that it is not run again for the filter.
        seen = plain.withColumn("judged", judge.asNondeterministic()(text))
        return _with_texts(seen.where(~F.col("judged.bad")).withColumn("new", F.col("judged.text")), docs, at)
    h = F.sha2(F.coalesce(text, F.lit("")), 256)
    texts = plain.select(h.alias("doc_id"), text.alias("text")).groupBy("doc_id").agg(F.first("text").alias("text"))
    hits = _counted(matches(texts, items, window)).where("n_hit > 0").select(F.col("doc_id").alias("h"), "contaminated", "spans")

    @F.arrow_udf("string")
    def shorter(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if t is None else without_spans(decoded(t), merged(x), most) for t, x in zip(utf8(texts), spans.to_pylist())], type=pa.string())

    held_rows = plain.withColumn("h", h).join(hits, "h", "left").where(~F.coalesce("contaminated", F.lit(False)))
    # Only texts with spans go to Python; the others stay null there.
    return _with_texts(held_rows.withColumn("new", shorter(F.when(F.col("spans").isNotNull(), text), "spans")), docs, at)


def merged(spans) -> list[tuple[int, int]]:
    """Spans of several passes, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["s"], x["e"]) for x in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _with_texts(plain: DataFrame, docs: DataFrame, at: dict[str, str]) -> DataFrame:
    """The columns of ``docs``, where ``new`` takes the place of the text if it is not null."""
    new = {"text": F.coalesce("new", at["text"])}
    if "n_chars" in at:
        new["n_chars"] = F.when(F.col("new").isNotNull(), F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(at["n_chars"]))
    return plain.select(*[new.get(c, F.col(at[c])).alias(c) for c in docs.columns])


def without_spans(text: str, spans: list[tuple[int, int]], most: int = 0) -> str:
    """The text without the word spans of more than ``most`` words; what lies between words stays on its left."""
    import re

    at = [m.span() for m in re.finditer("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)]
    out, done = [], 0
    for a, b in spans:
        if b - a > most:
            out.append(text[done : at[a][0]])
            done = at[b - 1][1]
    return "".join(out) + text[done:]

"""License scans (operator 10).

Two parts over whole texts. The base part lists every place where a phrase's
words stand consecutively. The method is an exact set-similarity join between
license templates and the text's blocks: its lines, and, as notices are wrapped,
its windows of as many words as the template has, over line ends. For lines,
tokens are ordered by their
document frequency in the whole corpus, rarest first; a block can reach
containment ``|T & B| >= t = ceil(threshold * |T|)`` only if it holds one of the
template's first ``|T| - t + 1`` tokens (prefix filter), has at least ``t`` tokens
(length filter), and if enough tokens of the template are left behind the
first shared one (positional filter). Survivors are verified by intersection,
so exactly the blocks that meet the threshold are found. Windows are counted
word by word for the templates whose prefix the text meets and of whose tokens
it holds ``t``.

Only template tokens can overlap, so only their frequencies are counted. The
templates are a parameter that the driver holds anyway; they are broadcast
once, and a text is compared with those alone whose prefix it meets. Documents,
which grow, are never shuffled.

Nulls: a null text is empty: no words, no labels, null positions, score 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rows import alnum_words, map_texts

#: Phrase and label of the base part.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Label and text of a license notice, as notices are commonly written.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit-notice", "Released under the MIT License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("all-rights-reserved", "Copyright all rights reserved"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)
THRESHOLD = 0.8


class TemplateIndex:
    """Prefix postings over templates whose tokens are ordered by frequency."""

    def __init__(self, templates, df: dict[bytes, int], threshold: float = THRESHOLD):
        self.order = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in alnum_words(t.encode())}, key=lambda w: (df.get(w, 0), w)))}
        self.rows: list[tuple[str, frozenset, int, int]] = []
        self.lengths: list[int] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in templates:
            tokens = sorted(set(alnum_words(text.encode())), key=self.order.__getitem__)
            if not tokens:
                continue
            need = max(1, math.ceil(round(threshold * len(tokens), 9)))
            for at, w in enumerate(tokens[: len(tokens) - need + 1]):
                self.postings.setdefault(w, []).append((len(self.rows), at))
            self.rows.append((label, frozenset(tokens), need, len(tokens)))
            self.lengths.append(len(alnum_words(text.encode())))
        self.probes = tuple(self.postings)

    def match(self, block: bytes) -> list[tuple[str, float]]:
        """Templates that the block contains to the threshold, with their containment."""
        tokens = set(alnum_words(block)) & self.order.keys()
        ordered = sorted(tokens, key=self.order.__getitem__)
        first: dict[int, tuple[int, int]] = {}
        for at_block, w in enumerate(ordered):
            for row, at in self.postings.get(w, ()):
                first.setdefault(row, (at, at_block))
        out = []
        for row, (at, at_block) in first.items():
            label, own, need, size = self.rows[row]
            if len(tokens) < need or 1 + min(size - at - 1, len(ordered) - at_block - 1) < need:
                continue
            shared = len(own & tokens)
            if shared >= need:
                out.append((label, shared / size))
        return out

    def match_windows(self, words: list[bytes], have: set[bytes]) -> list[tuple[str, float]]:
        """Templates that some window of as many words as the template contains to the threshold.

        Windows run over line ends. ``have``: the template tokens among ``words``.
        """
        out = []
        for row in sorted({row for w in have for row, _ in self.postings.get(w, ())}):
            (label, own, need, size), length = self.rows[row], self.lengths[row]
            if len(own & have) < need:
                continue
            hits = [(i, w) for i, w in enumerate(words) if w in own]
            held: dict[bytes, int] = {}
            first = most = 0
            for i, w in hits:
                held[w] = held.get(w, 0) + 1
                while hits[first][0] <= i - length:
                    gone = hits[first][1]
                    held[gone] -= 1
                    if not held[gone]:
                        del held[gone]
                    first += 1
                most = max(most, len(held))
            if most >= need:
                out.append((label, most / size))
        return out


def base_places(words: list[bytes], phrases=PHRASES) -> tuple[list[int], set[str]]:
    """Start of every place of every phrase, and the labels found."""
    starts, labels = [], set()
    for phrase, label in phrases:
        want = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(want[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(want)] == want:
                starts.append(at)
                labels.add(label)
    return starts, labels


def frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """In how many documents each template token occurs, over all documents.

    Each task counts its own; what travels is a row for each token and task.
    """
    import pyarrow as pa

    from tessera.llm.rows import utf8

    tokens = {w for _, t in templates for w in alnum_words(t.encode())}

    def count(batches):
        seen = dict.fromkeys(tokens, 0)
        for b in batches:
            for text in utf8(b.column("t")):
                for w in tokens.intersection(alnum_words(text)):
                    seen[w] += 1
        yield pa.RecordBatch.from_pydict({"w": [w.decode() for w in seen], "n": list(seen.values())})

    counts = docs.select(F.col("text").alias("t")).mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return {r["w"].encode(): r["n"] for r in counts.collect()}  # a row for each template token


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, places, base labels and all labels, and the highest containment, for every document."""
    held = docs.sparkSession.sparkContext.broadcast((templates, frequencies(docs, templates)))
    heads = tuple(dict.fromkeys(p.encode().split()[-1] for p, _ in phrases))

    def make() -> Callable:
        index = TemplateIndex(*held.value, threshold)

        def one(text: bytes | None) -> tuple:
            words = alnum_words(text)
            have = index.order.keys() & set(words)
            starts, base = base_places(words, phrases) if any(h in words for h in heads) else ([], set())
            labels, score = set(base), 1.0 if base else 0.0
            if any(p in have for p in index.probes):
                lines = text.split(b"\n")
                found = [x for block in lines for x in index.match(block)]
                if len(lines) > 1:
                    found += index.match_windows(words, have)
                for label, contained in found:
                    labels.add(label)
                    score = max(score, contained)
            return (
                len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), float(score),
            )

        return one

    long, text = T.LongType(), T.StringType()
    return map_texts(
        docs,
        make,
        [("n_words", long), ("n_base", long), ("first_word", long), ("last_word", long), ("base_labels", text), ("labels", text), ("score", T.DoubleType())],
    )

"""Language identification by hierarchical discrimination (operator 9).

First the language family, by one-versus-one linear support vector machines
over the families; then, within the family, one-versus-one machines over its
languages. Features are hashed counts of adjacent byte pairs and triples of
the whole text (letters only, others as a space), square-rooted and scaled to
length one.

Machines are fitted on a bounded sample: about ``PER_LANGUAGE`` rows of least
hash for each language, out of rows whose crc32 of the id is not 2 modulo 4
and whose language is known; ``SAMPLE`` rows at most, of which every language
has its share. An id that stands in many rows counts once for each language,
with the row whose text has the least hash. Families are a table of languages;
a language that it lacks is a family of its own. A choice among more than
``FAN`` branches is split: branches are put in order along the main direction
of their means and cut into ``FAN`` groups, which are discriminated first. So
machines grow with the number of languages, not with its square.

Nulls: a null text, or one without a letter, is ``und`` with score 0. A null id
is never held out and never learned from. Without any learned language all
rows are ``und``; with one, every text with a letter has that language. Bytes
that are no UTF-8 count as bytes of letters in the features.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rows import map_texts
from tessera.session import cut, discard

PER_LANGUAGE = 600
#: Training rows' features on the driver, at most: about 150 MB.
SAMPLE = 6_000
#: Branches of one choice, at most.
FAN = 16
#: A table of languages and their numbers of rows is broadcast up to so many rows.
BROADCAST_ROWS = 100_000
_PAIRS, _TRIPLES = 1 << 11, 1 << 12
WIDTH = _PAIRS + _TRIPLES
_CHUNK = 1 << 20

#: Members of the families that the table knows.
FAMILIES = {
    "germanic": ("da", "de", "en", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only {lang}")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def features(text: bytes) -> np.ndarray:
    """Square-rooted, length-one counts; texts are taken in pieces, so memory has a bound."""
    plain = b" " + text.translate(_LETTERS) + b" "
    counts = np.zeros(WIDTH)
    for at in range(0, len(plain), _CHUNK):
        a = np.frombuffer(plain[at : at + _CHUNK + 2], dtype=np.uint8).astype(np.uint32)
        if len(a) < 2:
            break
        two = a[:-1] * np.uint32(256) + a[1:]
        own = two[: _CHUNK]
        counts[:_PAIRS] += np.bincount((own * np.uint32(2_654_435_761)) >> np.uint32(21), minlength=_PAIRS)
        three = (two[:-1] * np.uint32(256) + a[2:])[:_CHUNK]
        counts[_PAIRS:] += np.bincount((three * np.uint32(2_246_822_519)) >> np.uint32(20), minlength=_TRIPLES)
    counts = np.sqrt(counts)
    return (counts / max(1e-12, float(np.linalg.norm(counts)))).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 150) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by accelerated descent. y: 1 or -1; the last column of x is 1."""
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))).astype(np.float32)
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    rate = 1 / (1 + 4 * c * float(weight.max()))
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = v - 2 * c / len(y) * ((weight * y * slack) @ x)
        new = v - rate * grad
        v = new + t / (t + 3) * (new - w)
        w = new
    return w


class OneVersusOne:
    """A machine for each pair of classes; votes are weighed by their odds."""

    def __init__(self, x: np.ndarray, names: list[str]):
        self.names = sorted(set(names))
        of = np.array(names)
        self.pairs = list(itertools.combinations(range(len(self.names)), 2))
        rows = []
        for a, b in self.pairs:
            own = (of == self.names[a]) | (of == self.names[b])
            rows.append(svm(x[own], np.where(of[own] == self.names[a], 1.0, -1.0).astype(np.float32)))
        self.w = np.array(rows, dtype=np.float32).reshape(len(rows), x.shape[1])

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if len(self.names) == 1:
            return self.names[0], 1.0
        margin = self.w[:, :-1] @ x + self.w[:, -1]
        p = 1 / (1 + np.exp(-3 * margin))
        total = np.zeros(len(self.names))
        for (a, b), q in zip(self.pairs, p):
            total[a] += q
            total[b] += 1 - q
        best = int(total.argmax())
        return self.names[best], float(total[best] / (len(self.names) - 1))


def _grouped(x: np.ndarray, heads: list[str]) -> list[str]:
    """For each row the group of its branch: branches along the main direction of their means, cut into ``FAN`` runs."""
    of = np.array(heads)
    names = sorted(set(heads))
    means = np.stack([x[of == n].mean(axis=0) for n in names])
    means -= means.mean(axis=0)
    v = np.ones(x.shape[1], dtype=x.dtype)
    for _ in range(20):
        v = means.T @ (means @ v) + 1e-12
        v /= np.linalg.norm(v)
    order = np.argsort(means @ v, kind="stable")
    group = {names[n]: f"group {at * FAN // len(names):02}" for at, n in enumerate(order)}
    return [group[h] for h in heads]


class Choice:
    """One-versus-one machines over the heads of the rows' paths, and the choices below each head."""

    def __init__(self, x: np.ndarray, paths: list[tuple[str, ...]]):
        heads = [p[0] for p in paths]
        if len(set(heads)) > FAN:
            heads = _grouped(x, heads)
            paths = [(h, *p) for h, p in zip(heads, paths)]
        self.machines = OneVersusOne(x, heads)
        of = np.array(heads)
        self.below: dict[str, Choice | None] = {}
        for h in self.machines.names:
            own = np.flatnonzero(of == h)
            rest = [paths[i][1:] for i in own]
            self.below[h] = Choice(x[own], rest) if rest[0] else None


class Hierarchy:
    """Families first, then the languages within the family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.empty = not langs
        if not self.empty:
            self.top = Choice(x, [(family_of(g), g) for g in langs])

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if self.empty or not has_letter(text):
            return "und", 0.0
        x = features(text)
        at, score, name = self.top, 1.0, ""
        while at is not None:
            name, p = at.machines.predict(x)
            score *= p
            at = at.below[name]
        return name, min(1.0, max(0.0, score))


def held_out(key: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Hierarchy:
    """Fit on the bounded sample; only the sampled texts are read for their features."""
    ids = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out()).select("doc_id", "lang")
    # Counts are a row for each language; ids are then chosen by their hash alone, so no language meets in one task.
    sizes = cut(ids.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    known = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    share = F.shiftrightunsigned(F.xxhash64("doc_id", "lang"), 11) / float(1 << 53)
    chosen = ids.join(known, "lang").select("doc_id", "lang", (share * F.col("n")).alias("place")).where(F.col("place") < PER_LANGUAGE)
    sample = chosen.distinct().orderBy("place", "lang", "doc_id").limit(SAMPLE).select("doc_id", "lang")
    rows = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("h")).join(F.broadcast(sample), ["doc_id", "lang"])  # SAMPLE ids at most

    def make() -> Callable:
        def one(text: bytes | None) -> tuple:
            if not has_letter(text):
                return None, None
            x = features(text)
            at = np.flatnonzero(x)
            return at.astype(np.int16), x[at]

        return one

    fields = [("at", T.ArrayType(T.ShortType())), ("x", T.ArrayType(T.FloatType()))]
    seen = map_texts(rows, make, fields, keys=("doc_id", "lang", "h")).where("at is not null")
    got = seen.groupBy("doc_id", "lang").agg(F.min_by(F.struct("at", "x"), "h").alias("v")).select("doc_id", "lang", "v.at", "v.x").toArrow()
    discard(sizes)
    first = {key: n for n, key in enumerate(zip(got["lang"].to_pylist(), got["doc_id"].to_pylist()))}
    order = sorted(first)
    x = np.zeros((len(order), WIDTH + 1), dtype=np.float32)
    x[:, -1] = 1.0  # for the bias
    places, values = got["at"].combine_chunks(), got["x"].combine_chunks()
    for i, key in enumerate(order):
        n = first[key]
        x[i, places[n].values.to_numpy()] = values[n].values.to_numpy()
    return Hierarchy(x, [lang for lang, _ in order])


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = train(docs)  # a few machines of WIDTH weights travel with the function
    out = map_texts(docs, lambda: model.predict, [("lang_pred", T.StringType()), ("score", T.DoubleType())])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

"""Operators that fit models or count pieces, and the pipeline."""

import base64
import zlib
from collections import Counter

import public_tokenizers as P
import pytest

import corpus_pipeline
from tessera.llm import decontam, langid, pieces, quality, secrets, simhash
from tests.conftest import SF
from tests.llm import brute
from tests.llm.test_contract import AWKWARD, ITEMS, awkward  # noqa: F401

MID = SF.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{MID}/{n}.parquet") for n in ("documents", "labels", "benchmark")}


def greedy(word, initial, inside):
    n, at, vocab = 0, 0, initial
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocab), None)
        if end is None:
            return pieces.UNKNOWN
        n, at, vocab = n + 1, end, inside
    return n


def test_longest_match_is_greedy():
    initial, inside = {b"a", b"ab", b"abcd", b"x"}, {b"b", b"bc", b"c", b"d", b"cde", b"cdef", b"e"}
    automaton = pieces.LongestMatch(initial, inside)
    words = {bytes(w) for n in range(6) for w in __import__("itertools").product(b"abcdefx", repeat=n)}
    assert all(automaton.count(w) == greedy(w, initial, inside) for w in words)


def test_token_counts(spark, awkward, tables):  # noqa: F811
    path = P.path("byte_bpe_50k.tiktoken")
    vocab = pieces.vocabulary(path)
    for df in (awkward, tables["documents"].limit(60), awkward.limit(0)):
        got = Counter(tuple(r) for r in pieces.counts(df, path).collect())
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            each = [greedy(w, *vocab) for w in (r["text"] or "").encode().split()]
            want[(r["doc_id"], len(each), sum(1 if n < 0 else n for n in each), sum(n < 0 for n in each))] += 1
        assert got == want


def test_language_held_out_accuracy(tables):
    docs = tables["documents"]
    got = {r["doc_id"]: r for r in langid.predicted(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i]["held_out"]} == set(held)
    known = [i for i in held if truth[i] is not None]
    assert sum(got[i]["lang_pred"] == truth[i] for i in known) / len(known) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_awkward(spark, awkward):  # noqa: F811
    got = langid.predicted(awkward).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in AWKWARD)
    und = Counter(i for i, t in AWKWARD if not any(c.isalpha() for c in t or ""))
    assert Counter(r["doc_id"] for r in got if r["lang_pred"] == "und") == und
    none = awkward.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.predicted(none).collect()} == {"und"}
    assert langid.predicted(awkward.limit(0)).count() == 0


def test_quality_on_labels_outside_the_training_rows(tables):
    labels = tables["labels"].where("doc_id % 2 = 0")
    got = {r["doc_id"]: r for r in quality.scored(tables["documents"], labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in tables["labels"].where("doc_id % 2 = 1 and quality is not null").collect()}
    right = sum(got[i]["kept"] == (q == 1) for i, q in truth.items() if i in got)
    assert right / sum(i in got for i in truth) >= 0.95


def test_quality_awkward(spark, awkward):  # noqa: F811
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (empty, odd):
        out = quality.kept(awkward, labels)
        assert out.columns == awkward.columns
        assert quality.scored(awkward, labels).count() == len(AWKWARD)
        assert quality.scored(awkward.limit(0), labels).count() == 0
    assert quality.kept(awkward, empty).count() == len(AWKWARD)


def test_cleaned(spark, awkward, monkeypatch):  # noqa: F811
    frame = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = Counter(i for i, t in AWKWARD if not brute.contamination(t, ITEMS)[-1])
    assert Counter(r["doc_id"] for r in decontam.cleaned(awkward, frame).collect()) == want
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 10)
    out = decontam.cleaned(awkward, frame)
    assert out.columns == awkward.columns and Counter(r["doc_id"] for r in out.collect()) == want


def test_without_spans():
    assert decontam.without_spans("A b, c D e!", [(1, 3)]) == "A  D e!"
    assert decontam.without_spans("A b, c D e!", [(1, 3)], most=2) == "A b, c D e!"


def test_pipeline_against_brute_force(spark, tables):
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, MID).collect()}
    docs = {r["doc_id"]: r["text"] for r in quality.kept(tables["documents"], tables["labels"]).select("doc_id", "text").collect()}
    docs = {i: docs[i] for i in brute.deduplicated(list(docs.items()))}
    items = [(r["item_id"], r["text"]) for r in tables["benchmark"].collect()]
    import itertools

    grams = {g for _, t in items for g in itertools.pairwise(brute.words(t))}
    docs = {i: t for i, t in docs.items() if not grams.intersection(itertools.pairwise(brute.words(t))) or not brute.contamination(t, items)[-1]}
    docs = {i: secrets.redact(t, [(a, b) for _, a, b in secrets.find((t or "").encode())]) for i, t in docs.items()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    assert {i: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for i, r in out.items()} == {i: brute.bpe(t, ranks, P.PATTERN) for i, t in docs.items()}

"""Notices wrapped over lines, against brute force over word windows."""

import random
import textwrap
from collections import Counter

import pytest

from tessera.llm import licenses
from tests.conftest import SF
from tests.llm import brute

BODY = dict(licenses.TEMPLATES)
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are
# met:"""


def windowed(text):
    """Label to containment, over lines and windows."""
    out = {}
    ws = brute.words(text)
    for label, body in licenses.TEMPLATES:
        t = brute.words(body)
        blocks = [brute.words(x) for x in (text or "").split("\n")] + [ws[i : i + len(t)] for i in range(max(1, len(ws) - len(t) + 1))]
        part = max(len(set(t) & set(b)) / len(set(t)) for b in blocks)
        if part >= licenses.THRESHOLD - 1e-9:
            out[label] = part
    return out


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()}


def test_wrapped_mit_and_bsd(spark):
    short = "\n".join(textwrap.wrap(BODY["mit-text"], 20))
    got = scanned(spark, [f"A b\n{MIT}\nc", BSD, short, "Licensed under\nCC BY\n4.0", "Permission is granted to\nuse this software free of charge"])
    assert got == {0: ("mit-text", 1.0), 1: ("bsd", 1.0), 2: ("mit-text", 1.0), 3: ("cc-by,cc-by-nc,cc-by-sa", 1.0), 4: ("", 0.0)}


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        ws = BODY[rng.choice(list(BODY))].split()
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(len(ws) + 1)
            ws[at : at + rng.randrange(2)] = rng.choices(["the", "of", "filler", "and", "license"], k=rng.randrange(3))
        ws = ["x"] * rng.randrange(4) + ws + ["y"] * rng.randrange(4)
        texts.append("".join(w + rng.choice(" \n") for w in ws))
    got = scanned(spark, texts)
    for i, text in enumerate(texts):
        want, base = windowed(text), brute.licenses(text)[4]
        assert got[i][0] == ",".join(sorted({*want, *filter(None, base.split(","))}))
        assert abs(got[i][1] - (1.0 if base else max(want.values(), default=0.0))) < 1e-12


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = Counter()
    for r in docs.collect():
        base = brute.licenses(r["text"])[4]
        want[r["doc_id"], ",".join(sorted({*windowed(r["text"]), *filter(None, base.split(","))}))] += 1
    assert Counter((r["doc_id"], r["labels"]) for r in licenses.scan(docs).collect()) == want

"""Long benchmark spans leave the documents that are kept."""

import pytest

from tessera.llm import decontam

PASSAGE = " ".join(f"item{i}" for i in range(100))
FILLER = [f"word{i}" for i in range(3000)]


def text(*parts):
    return " ".join([*FILLER[:1500], *parts, *FILLER[1500:]])


@pytest.mark.parametrize("block", [200_000, 50])
def test_long_spans_are_cut_out(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    quote = " ".join(PASSAGE.split()[:decontam.SPAN_WORDS])
    texts = {1: text(PASSAGE), 2: text(quote), 3: "some " + PASSAGE, 4: None, 5: text(quote + " item50", "Über", quote), 6: text()}
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([(1, PASSAGE), (2, " ".join(f"other{i}" for i in range(40)))], "item_id long, text string")
    out = decontam.cleaned(docs, items)
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    want = {1: text(""), 2: texts[2], 4: None, 5: text("", "Über", quote), 6: texts[6]}
    assert got == {i: (t, len(t or "")) for i, t in want.items()}

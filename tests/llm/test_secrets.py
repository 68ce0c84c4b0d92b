"""Private keys leave no part of themselves behind."""

import base64
import random

import pytest

from tessera.llm import secrets

_BYTES = random.Random(7).randbytes(600)
BODY = base64.b64encode(_BYTES).decode()
LINES = [BODY[i : i + 64] for i in range(0, len(BODY), 64)]
LAST = [*LINES[:-1], LINES[-1][:7]]
BEGIN, END = "-----BEGIN {}PRIVATE KEY-----", "-----END {}PRIVATE KEY-----"
HEADERS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF\n\n"


def clean(text):
    return secrets.redact(text, [(a, b) for _, a, b in secrets.find(text.encode())])


@pytest.mark.parametrize("kind", ["", "RSA ", "EC ", "OPENSSH ", "ENCRYPTED "])
@pytest.mark.parametrize("gap", ["\n", "\r\n", "\\n", " ", "\n> "])
@pytest.mark.parametrize("end", [True, False])
def test_whole_key_is_redacted(kind, gap, end):
    lines = LAST if end or gap != " " else LINES[:-1]
    key = gap.join([BEGIN.format(kind), *lines, *([END.format(kind)] if end else [])])
    assert clean(f"é before\n{key}\n\nafter it all") == "é before\n[SECRET]\n\nafter it all"


def test_headers_and_several_keys():
    body = "\n".join(LAST)
    for end in ("", "\n" + END.format("RSA ")):
        assert clean("a " + BEGIN.format("RSA ") + "\n" + HEADERS + body + end + "\n\nb") == "a [SECRET]\n\nb"
    one, two = BEGIN.format("") + "\n" + body, BEGIN.format("EC ") + "\n" + body + "\n" + END.format("EC ")
    assert clean(f"{one}\n\nkept words here\n{two}\n{two} end") == "[SECRET]\n\nkept words here\n[SECRET]\n[SECRET] end"
    assert clean("see " + BEGIN.format("") + " for the form of keys") == "see [SECRET] for the form of keys"


def test_stage_leaves_no_body(spark):
    text = "notes\n" + "\n".join([BEGIN.format("RSA "), *LAST, END.format("RSA ")]) + "\nmore"
    docs = spark.createDataFrame([(1, text), (2, "plain"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    assert got == {1: "notes\n[SECRET]\nmore", 2: "plain", 3: None}

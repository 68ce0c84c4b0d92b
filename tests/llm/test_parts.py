"""Parts of the models against plain versions, and the secret scan's own kinds and ledger."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import langid, quality, secrets


def test_logistic_is_the_minimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=60) > 0).astype(float)
    model = quality.Logistic(x, y, 0.5)
    z = model._z(x)

    def loss(w):
        m = z @ w
        return np.sum(np.log1p(np.exp(m)) - y * m) + 0.5 * (0.5 * w[:3] @ w[:3] + 1e-6 * w[3] ** 2)

    best = loss(model.w)
    for i in range(4):
        for step in (-0.01, 0.01):
            assert loss(model.w + step * np.eye(4)[i]) > best


def test_text_view_by_hand():
    v = quality.text_view(b"Ab ab | 1!\nAb ab | 1!\n")
    n, words = 22, 8
    assert np.isclose(v[0], (2 / n) ** 0.5)  # A, A
    assert np.isclose(v[1], (6 / n) ** 0.5)  # b ab, twice
    shape = len(v) - quality._WORDS
    hashed = Counter(zlib.crc32(w.lower()) % quality._WORDS for w in b"Ab ab | 1! Ab ab | 1!".split())
    assert {i: c / words for i, c in hashed.items()} == {i: round(float(x) ** 2, 9) for i, x in enumerate(v[shape:]) if x}
    assert np.isclose(v[shape - 4], 0.5)  # one of two lines repeats


def test_views_teach_each_other():
    """Only the text view can tell the labelled rows apart; its pseudo-labels teach the other view."""
    rng = np.random.default_rng(2)
    n, m = 80, 400
    y = (np.arange(n) // 4 % 2).astype(float)
    text = rng.normal(size=(n, quality.TEXT_WIDTH)) * 0.01
    text[:, 0] += y * 4
    meta = np.zeros((n, quality.META_WIDTH))
    hidden = (np.arange(m) % 2).astype(float)
    more_text = rng.normal(size=(m, quality.TEXT_WIDTH)) * 0.01
    more_text[:, 0] += hidden * 4
    more_meta = np.zeros((m, quality.META_WIDTH))
    more_meta[:, 1] = hidden
    lonely = quality.CoTrained(text, meta, y, more_text, more_meta, rounds=0)
    taught = quality.CoTrained(text, meta, y, more_text, more_meta)
    tell = lambda c: c.models[1].logit(more_meta)[hidden == 1].mean() - c.models[1].logit(more_meta)[hidden == 0].mean()
    assert abs(tell(lonely)) < 1e-6 and tell(taught) > 1


def test_language_features_by_hand():
    got = langid.features("Äb ab".encode())
    plain = b" " + bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in "Äb ab".encode()) + b" "
    want = np.zeros(langid.WIDTH)
    for a, b in zip(plain, plain[1:]):
        want[((a * 256 + b) * 2_654_435_761 & 0xFFFFFFFF) >> 21] += 1
    for a, b, c in zip(plain, plain[1:], plain[2:]):
        want[langid._PAIRS + (((a * 256 + b) * 256 + c) * 2_246_822_519 & 0xFFFFFFFF) // (1 << 20)] += 1
    want = np.sqrt(want)
    assert np.allclose(got, want / np.linalg.norm(want), atol=1e-6)


def test_machine_is_the_minimum():
    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(size=(40, 4)) / 2, np.ones((40, 1))]).astype(np.float32)
    y = np.where(x[:, 0] > 0, 1.0, -1.0).astype(np.float32)
    w = langid.svm(x, y, steps=3000).astype(float)
    weight = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    loss = lambda w: 0.5 * w @ w + 10.0 / len(y) * np.sum(weight * np.maximum(0, 1 - y * (x @ w)) ** 2)
    assert all(loss(w + s * np.eye(5)[i]) >= loss(w) - 1e-6 for i in range(5) for s in (-0.02, 0.02))


def test_many_languages(monkeypatch):
    """More branches than one choice may have: groups first, and still the right language."""
    monkeypatch.setattr(langid, "FAN", 4)
    langs = [f"l{i:02}" for i in range(19)]
    texts = {g: " ".join(f"{chr(97 + i)}{chr(97 + (i * 7 + k) % 26)}{chr(97 + i)}" for k in range(9)) for i, g in enumerate(langs)}
    rows = [(g, t + f" {n}") for g, t in texts.items() for n in range(3)]
    x = np.hstack([np.stack([langid.features(t.encode()) for _, t in rows]), np.ones((len(rows), 1), dtype=np.float32)])
    model = langid.Hierarchy(x, [g for g, _ in rows])

    def widest(choice):
        return max([len(choice.machines.names), *[widest(c) for c in choice.below.values() if c]])

    assert widest(model.top) <= 4
    assert all(model.predict(t.encode())[0] == g and 0 <= model.predict(t.encode())[1] <= 1 for g, t in texts.items())


OWN = {
    "pem": r"-----BEGIN (?:[A-Z]{2,12} )?PRIVATE KEY-----.*?-----END (?:[A-Z]{2,12} )?PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "hosted": r"gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}",
    "login": r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._-]+:[^\x00\x01-\x20@/:]{3,}@",
}


def test_own_kinds_and_spans(spark):
    jwt = "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12
    texts = [
        f"é {jwt} and ghp_{'A1' * 20}, sk_live_{'x' * 16}",
        "ü https://user.name:p4ssword@host/x postgres://u:ab@h ftp://a:bcd@e",
        "-----BEGIN EC PRIVATE KEY-----\nMIIB\n-----END EC PRIVATE KEY----- 日本 " + jwt,
        f"eyJshort.eyJ.x ghp_{'A' * 35} sk_live_{'x' * 15} PRIVATE KEY-----",
    ]
    got = {r["doc_id"]: r["spans"] for r in secrets.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        want = sorted((m.start(), 3 + k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p) in enumerate(OWN.items()) for m in re.finditer(p, t, re.S))
        assert [s for s in got[i].split(",") if s.split(":")[0] in OWN] == [s for _, _, s in want]


def test_ledger_over_versions_and_paths(spark, tmp_path, monkeypatch):
    """Findings reach every path of every version; known blobs are not scanned again, but under new rules."""
    ledger = str(tmp_path / "ledger")
    key = "token = abcdefgh12"
    rows = [("a.py", 1, key), ("a.py", 2, "clean now"), ("copy/a.py", 1, key), ("b.py", 1, None)]
    versions = spark.createDataFrame(rows, "path string, version int, text string").withColumn("at", F.concat_ws("@", "path", F.col("version").cast("string")))
    found = {r["at"]: len(r["spans"]) for r in secrets.scan(versions, ledger, key="at").collect()}
    assert found == {"a.py@1": 1, "a.py@2": 0, "copy/a.py@1": 1, "b.py@1": 0}
    held = spark.read.parquet(ledger)
    assert held.count() == 3
    monkeypatch.setattr(secrets, "find", lambda t: 1 / 0)  # would fail if anything were scanned
    assert {r["at"]: len(r["spans"]) for r in secrets.scan(versions, ledger, key="at").collect()} == found
    monkeypatch.undo()
    held.write.mode("append").parquet(ledger)  # two runs that overlapped
    assert Counter(r["at"] for r in secrets.scan(versions, ledger, key="at").collect()) == Counter(list(found))
    monkeypatch.setattr(secrets, "RULE_VERSION", "other")
    secrets.update_ledger(versions, ledger, key="at")
    assert spark.read.parquet(ledger).where("rule_version = 'other'").count() == 3

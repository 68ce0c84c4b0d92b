"""Quality classifier by co-training (operator 7).

Two views of a document: its text (hashed words and shape statistics of the
whole text) and its page metadata (source, language, stated length). A logistic
regression on each view starts from the labelled rows; over ``ROUNDS`` rounds
each names the unlabelled rows it is surest of, and these pseudo-labels join
the other view's training rows. Each view is then calibrated on labelled rows
kept out of its training, and a regression over the two calibrated log-odds,
fitted on rows kept out of both, weighs the views. All documents are scored.

Training rows are a bounded sample of the documents: the ``labelled`` and
``unlabelled`` ids of least hash (parameters, with ``LABELLED`` and
``UNLABELLED`` as defaults). Only ids are sorted; texts are read for the sample
alone, and an id that stands in many rows counts once, with the row whose
content has the least hash.

Nulls: a null text is the empty text; null metadata is a value of its own, and
so is a length that is no number. Ids labelled more than once take their mean
(0.5 or more: good); null labels are ignored. With fewer than ``LEAST_LABELS``
labelled documents, or labels of one kind only, nothing can be fitted: every
document gets the share of good labels (1.0 without any) and is kept at 0.5 or
more.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.rows import numbered, utf8

#: Bounds of the training sample. The README gives the effect of the second.
LABELLED, UNLABELLED = 8_000, 4_000
LEAST_LABELS = 8
ROUNDS = 4
#: Share of the unlabelled rows that each view names for each class and round.
SURE = 0.05
#: A view names no row of which its calibrated probability is less sure.
SURE_LEAST = 0.9
THRESHOLD = 0.5

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)),
    "digit": b"0123456789",
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "bar": b"|",
    "line": b"\n",
}
#: Columns of hashed words.
_WORDS = 256
TEXT_WIDTH = len(_KINDS) + 6 + _WORDS
_SOURCES, _LANGS = 32, 16
META_WIDTH = _SOURCES + _LANGS + 3
#: Penalties of the views' columns: hashed words are many and weak beside the shape.
RIDGES = (np.repeat([3.0, 100.0], [TEXT_WIDTH - _WORDS, _WORDS]), np.full(META_WIDTH, 1.0))


def text_view(text: bytes | None) -> np.ndarray:
    """Words and shape of the whole text; roots of shares, so that length does not matter by itself and small shares show."""
    text = text or b""
    n = max(1, len(text))
    shares = [((len(text) - len(text.translate(None, k))) / n) ** 0.5 for k in _KINDS.values()]
    words = text.split()
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x]
    again = sum(map(eq, words, words[1:])) / w
    shape = [
        *shares,
        shares[0] / max(1e-9, shares[0] + shares[1]),
        again,
        1 - len(set(lines)) / max(1, len(lines)),
        min(30.0, sum(map(len, words)) / w),
        float(np.log1p(len(words))),
        len(set(words)) / w,
    ]
    hashes = np.fromiter(map(zlib.crc32, text.lower().split()), dtype=np.uint32, count=len(words))
    return np.concatenate([shape, np.sqrt(np.bincount(hashes & (_WORDS - 1), minlength=_WORDS) / w)])


def meta_view(source: str | None, lang: str | None, n_chars: float | None) -> list[float]:
    out = [0.0] * META_WIDTH
    if n_chars is not None and not np.isfinite(n_chars):
        n_chars = None
    out[zlib.crc32(f"s:{source}".encode()) % _SOURCES] = 1.0
    out[_SOURCES + zlib.crc32(f"l:{lang}".encode()) % _LANGS] = 1.0
    out[-3] = float(np.log1p(max(0, n_chars or 0)))
    out[-2] = float(n_chars is None)
    out[-1] = float((n_chars or 0) < 200)
    return out


class Logistic:
    """Ridge logistic regression on standardised columns, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float | np.ndarray = 0.1):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._z(x)
        self.w = np.zeros(z.shape[1])
        penalty = np.append(np.broadcast_to(ridge, x.shape[1]), 1e-6)
        for _ in range(30):
            p = _sigmoid(z @ self.w)
            grad = z.T @ (p - y) + penalty * self.w
            hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            self.w -= step
            if np.abs(step).max() < 1e-8:
                break

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -20, 20), np.ones((len(x), 1))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._z(x) @ self.w, -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class CoTrained:
    """Both views' models, their calibrations and the weights of the two."""

    def __init__(self, text, meta, y, more_text, more_meta, rounds: int = ROUNDS):
        self.share = float(y.mean()) if len(y) else 1.0
        self.single = len(y) < LEAST_LABELS or len(set(y.tolist())) < 2
        if self.single:
            return
        # Rows for the views, for their calibration, and for weighing them; where a part lacks a class, all rows serve all three.
        part = np.arange(len(y)) % 4
        learn, check, weigh = part >= 2, part == 0, part == 1
        if any(len(set(y[p].tolist())) < 2 for p in (learn, check, weigh)):
            learn = check = weigh = np.ones(len(y), dtype=bool)
        views = [text, meta]
        free = [more_text, more_meta]
        train = [(v[learn], y[learn]) for v in views]
        open_rows = np.arange(len(more_text))
        # A view must be surer than the share of the class by itself makes it.
        good, bad = max(SURE_LEAST, (1 + self.share) / 2), max(SURE_LEAST, 1 - self.share / 2)
        for _ in range(rounds):
            models = [Logistic(*t, r) for t, r in zip(train, RIDGES)]
            if not len(open_rows):
                break
            named: dict[int, float] = {}
            for i, model in enumerate(models):
                fit = Logistic(model.logit(views[i][check])[:, None], y[check])
                p = _sigmoid(fit.logit(model.logit(free[i][open_rows])[:, None]))
                order = np.argsort(p, kind="stable")
                most = max(1, int(SURE * len(open_rows)))
                pick = [(k, 0.0) for k in order[:most] if 1 - p[k] >= bad] + [(k, 1.0) for k in order[::-1][:most] if p[k] >= good]
                if pick:
                    at = open_rows[[k for k, _ in pick]]
                    x, t = train[1 - i]
                    train[1 - i] = np.vstack([x, free[1 - i][at]]), np.concatenate([t, [c for _, c in pick]])
                    named |= dict.fromkeys(at.tolist(), 1.0)
            open_rows = np.array([r for r in open_rows if r not in named], dtype=np.int64)
        self.models = [Logistic(*t, r) for t, r in zip(train, RIDGES)]
        self.calibrations = [Logistic(m.logit(v[check])[:, None], y[check]) for m, v in zip(self.models, views)]
        both = np.hstack([c.logit(m.logit(v[weigh])[:, None])[:, None] for c, m, v in zip(self.calibrations, self.models, views)])
        self.joint = Logistic(both, y[weigh])

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good by text, by metadata, and by both."""
        if self.single:
            same = np.full(len(text), self.share)
            return same, same, same
        views = [c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrations, self.models, (text, meta))]
        return _sigmoid(views[0]), _sigmoid(views[1]), _sigmoid(self.joint.logit(np.stack(views, axis=1)))


def _views(texts, sources, langs, lengths) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([text_view(t) for t in texts]).reshape(-1, TEXT_WIDTH)
    meta = np.array([meta_view(s, x, n) for s, x, n in zip(sources, langs, lengths)]).reshape(-1, META_WIDTH)
    return text, meta


def _least(ids: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows whose ids have the least hash."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _inputs(docs: DataFrame) -> DataFrame:
    """doc_id and what the views read."""
    return docs.select("doc_id", "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").try_cast("double").alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> CoTrained:
    """Fit on the bounded sample; the sampled rows' views come to the driver."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct().join(marked, "doc_id", "left")
    wanted = F.broadcast(_least(ids.where("y is not null"), labelled).unionByName(_least(ids.where("y is null"), unlabelled)))
    # Views, not texts, come to the driver: one of each id.
    one = _inputs(docs).join(wanted, "doc_id")
    seen = one.select("doc_id", "y", F.xxhash64("text", "source", "lang", "n_chars").alias("h"), _view_udf()("text", "source", "lang", "n_chars").alias("v"))
    got = seen.groupBy("doc_id", "y").agg(F.min_by("v", "h").alias("v")).select("doc_id", "y", "v").toArrow()
    ids = got["doc_id"].to_pylist()
    order = sorted(range(len(ids)), key=lambda n: (zlib.crc32(str(ids[n]).encode()), ids[n]))
    x = got["v"].combine_chunks().flatten().to_numpy().reshape(-1, TEXT_WIDTH + META_WIDTH)[order].astype(float)
    y = got["y"].to_numpy()[order]
    have = ~np.isnan(y)
    a, b = x[:, :TEXT_WIDTH], x[:, TEXT_WIDTH:]
    return CoTrained(a[have], b[have], y[have], a[~have], b[~have])


def _lists(text, source, lang, n_chars):
    return utf8(text), source.to_pylist(), lang.to_pylist(), n_chars.to_pylist()


def _view_udf():
    @F.arrow_udf("array<float>")
    def view(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        return pa.array(list(np.hstack(_views(*_lists(text, source, lang, n_chars))).astype(np.float32)), type=pa.list_(pa.float32()))

    return view


def _score_udf(model: CoTrained):
    @F.arrow_udf("struct<text_score double, meta_score double, score double>")
    def score(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        found = model.score(*_views(*_lists(text, source, lang, n_chars)))
        return pa.StructArray.from_arrays([pa.array(np.asarray(f, dtype=float)) for f in found], names=["text_score", "meta_score", "score"])

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, each view's score, the joint score, and whether the document is kept."""
    s = _score_udf(train(docs, labels))("text", "source", "lang", "n_chars")
    return _inputs(docs).select("doc_id", s.alias("s")).select("doc_id", "s.text_score", "s.meta_score", "s.score", (F.col("s.score") >= THRESHOLD).alias("kept"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject; the same columns, decided row by row."""
    model = train(docs, labels)
    plain, at = numbered(docs)
    c = {n: F.col(at[n]) for n in ("text", "source", "lang", "n_chars")}
    s = _score_udf(model)(c["text"], c["source"].cast("string"), c["lang"].cast("string"), c["n_chars"].try_cast("double"))
    return plain.withColumn("s", s).where(F.col("s.score") >= THRESHOLD).drop("s").toDF(*docs.columns)

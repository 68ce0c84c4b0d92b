"""Secret scans over an incremental blob ledger (operator 2).

Every text is a blob, addressed by the SHA-256 of its content. The ledger is a
Parquet folder of (blob, rule version, findings): a scan hashes all rows, drops
blobs that the ledger already holds for this rule version, keeps one copy of
each unseen blob (partial aggregation first, so copies do not travel), scans
it, appends the findings, and joins the ledger back to every row. A second run
over the same texts scans nothing; a new rule version, which is a digest of the
patterns, scans each blob once. An entry is one row, complete in itself; where
two runs that overlap leave a blob with several, which are equal, one counts.

All characters that a rule can match are ASCII, so rules run on UTF-8 bytes
and only the ends of spans are turned into code points.

Nulls: a null text is the empty text: no spans. Null and repeated keys keep
their rows. An empty table makes an empty result. Bytes that are no UTF-8 count
as U+FFFD, and stand so in a redacted text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rows import decoded, map_texts, numbered, utf8
from tessera.session import work_path

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_BEGIN = re.compile(rb"-----BEGIN (?:[A-Z]{2,12} )?PRIVATE KEY-----")
_END = re.compile(rb"-----END (?:[A-Z]{2,12} )?PRIVATE KEY-----")
#: What follows a header whose END line is missing: named fields, then long base64 runs and lines of nothing but base64. A line break may be written out, as in JSON.
_BREAK = rb"[\x20\t>]*(?:\r?\n|\r|\\r\\n|\\n)[\x20\t>]*"
_BODY = re.compile(rb"(?:%b[A-Za-z][A-Za-z0-9-]*:[^\r\n\\]*)*(?:%b)*(?:(?:\s|\\[nr])*[A-Za-z0-9+/=]{16,}|%b[A-Za-z0-9+/=]+(?=[\x20\t]*(?:[\r\n\\\"']|\Z)))*" % (_BREAK, _BREAK, _BREAK))

#: Base kinds, in the order in which spans that start together are listed.
BASE = ("assign", "access", "hex")
#: Further kinds: literal that must occur, pattern.
MORE: dict[str, tuple[bytes, re.Pattern]] = {
    "pem": (b"PRIVATE KEY-----", _BEGIN),
    "jwt": (b"eyJ", re.compile(rb"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")),
    "hosted": (b"_", re.compile(rb"(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,})")),
    "login": (b"://", re.compile(rb"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._-]+:[^\x00-\x20@/:]{3,}@")),
}
KINDS = (*BASE, *MORE)

_ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(rb"[0-9a-f]{32,}")

#: Names the rules in the ledger: a digest of all patterns and least lengths.
RULE_VERSION = hashlib.sha256(
    b"\n".join([*(p.pattern for p in (_ASSIGN, _ACCESS, _HEX, _BEGIN, _END, _BODY)), b"8", *(k.encode() + b":" + lit + b":" + p.pattern for k, (lit, p) in MORE.items())])
).hexdigest()[:16]

#: Findings of more bytes than this are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def _key_end(text: bytes, at: int) -> int:
    """Where the key ends whose header ends at ``at``: with its END line, or without one with its body."""
    following = _BEGIN.search(text, at)
    end = _END.search(text, at, following.start() if following else len(text))
    return end.end() if end else _BODY.match(text, at).end()


def find(text: bytes | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed.

    For access and hex a run's first match is its longest, so the least length
    can stand in the pattern; an assignment that is too short still uses up its
    text, so its length is checked afterwards.
    """
    if not text:
        return []
    got: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        got += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(low) if m.end() - m.start(2) >= 8]
    if b"AKIA" in text:
        got += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    got += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for k, (literal, pattern) in enumerate(MORE.values(), len(BASE)):
        if literal in text:
            got += [(m.start(), k, _key_end(text, m.end()) if pattern is _BEGIN else m.end()) for m in pattern.finditer(text)]
    if not got:
        return []
    got.sort()
    if text.isascii():
        return [(KINDS[k], a, b) for a, k, b in got]
    ends = sorted({x for a, _, b in got for x in (a, b)})
    at, point, done = {}, 0, 0
    for x in ends:
        point += len(decoded(text[done:x]))
        at[x], done = point, x
    return [(KINDS[k], at[a], at[b]) for a, k, b in got]


def blobs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("k"), F.sha2(whole, 256).alias("blob_id"), whole.alias("t"))


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def update_ledger(versions: DataFrame, ledger: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scan the blobs that ``ledger`` lacks for this rule version; return its entries for the version."""
    spark = versions.sparkSession
    unseen = blobs(versions, key, text).select("blob_id", "t")
    if _exists(spark, ledger):
        seen = spark.read.parquet(ledger).where(F.col("rule_version") == RULE_VERSION).select("blob_id")
        unseen = unseen.join(seen, "blob_id", "left_anti")
    once = unseen.groupBy("blob_id").agg(F.first("t").alias("t"))
    scanned = map_texts(once, lambda: lambda t: (find(t),), [("spans", T.ArrayType(SPAN))], keys=("blob_id",), text="t")
    scanned.withColumn("rule_version", F.lit(RULE_VERSION)).write.mode("append").parquet(ledger)
    return spark.read.parquet(ledger).where(F.col("rule_version") == RULE_VERSION)


def _findings(entries: DataFrame) -> DataFrame:
    """(blob_id, spans) of each blob with findings, once.

    Marked for broadcast if its counted size allows it; else Spark shuffles, and splits hot blobs.
    """
    found = entries.where(F.size("spans") > 0).groupBy("blob_id").agg(F.first("spans").alias("spans"))
    n, m = found.agg(F.count("*"), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    return F.broadcast(found) if n * 120 + m * 40 <= BROADCAST_BYTES else found


def scan(docs: DataFrame, ledger: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, blob_id and spans of every row; the ledger is new if no path is given.

    Only blobs with findings are joined back, so rows of a hot clean blob meet
    no partner; Spark splits a hot blob with findings.
    """
    ledger = ledger or work_path(docs.sparkSession, "ledger")
    found = _findings(update_ledger(docs, ledger, key, text))
    return (
        blobs(docs, key, text)
        .select("k", "blob_id")
        .join(found, "blob_id", "left")
        .select(F.col("k").alias(key), "blob_id", F.coalesce("spans", F.array().cast(T.ArrayType(SPAN))).alias("spans"))
    )


def _listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    found = scan(docs, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(text: str | None, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones merged, replaced by ``mark``."""
    out, done = [], 0
    for a, b in sorted(spans):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return text if not out else "".join(out) + text[done:]


def redacted(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` with secrets replaced; the same columns; rows without secrets are untouched.

    Every row takes its own blob's findings, by content, so null and repeated
    ids do not matter. ``n_chars``, where there is one, follows the new text.
    """
    ledger = ledger or work_path(docs.sparkSession, "ledger")
    found = _findings(update_ledger(docs, ledger))
    plain, at = numbered(docs)
    text = F.col(at["text"])
    joined = plain.withColumn("blob_id", F.sha2(F.coalesce(text, F.lit("")), 256)).join(found, "blob_id", "left")

    @F.arrow_udf("string")
    def clean(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redact(decoded(t), [(s["start"], s["end"]) for s in x]) for t, x in zip(utf8(texts), spans.to_pylist())], type=pa.string())

    hit = F.col("spans").isNotNull()
    # Only texts with findings go to Python; the others stay null there.
    out = joined.withColumn("clean", clean(F.when(hit, text), "spans"))
    new = {"text": F.when(hit, F.col("clean")).otherwise(text)}
    if "n_chars" in at:
        new["n_chars"] = F.when(hit, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(at["n_chars"]))
    return out.select(*[new.get(c, F.col(at[c])).alias(c) for c in docs.columns])


def base_digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in BASE).encode()).hexdigest()

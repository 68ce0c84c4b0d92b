"""URL filters (operator 1).

A list holds rules (host and path prefix, with a verdict), listed canonical
URLs and listed whole sites. Every entry has one string key; a URL has a few
keys it could be listed under: its canonical form, and for each host suffix
the site and the path prefixes of the lengths that rules have. A blocked Bloom
filter of the listed keys (256-bit blocks, one bit in each of four 64-bit
words) drops keys that are not listed; what passes goes to an exact hash join
with the list, which removes false positives. The filter is a table of blocks:
building it is one grouped ``bit_or``, probing it one join on the block's number.

Filter and list are broadcast while their sizes allow it. Beyond that the
distinct keys (a hot site's key is aggregated before it is shuffled) are dealt
by block to the filter's partitions, and what passes is dealt by key to the
list's; the entries that were met, never the list, go back to the URLs.

Work is done once for each distinct (host, path), and the decisions are written
before they are joined to the rows, so Spark can split the rows of a hot URL.
Rows without a host meet no partner and are spread by a salt.

Nulls: a null url, or one without ``://``, has empty host and path, no rule,
and the method's verdict ``allow``. Null ids and repeated rows keep their rows.
An empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut

#: Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Unwanted sellers under each reserved example domain: whole sites, and their numbered pages as canonical URLs.
SITES = tuple(f"{site}.example.{end}" for site in ("adult-x", "casino-win", "cheap-pills", "spam-farm") for end in ("com", "net", "org"))
LISTED = tuple(f"http://{site}/" for site in SITES)
LANGS, NUMBERS = ("de", "en", "es", "fr"), 1000

#: Bits of filter for each listed key: about one key in 2,000 passes falsely.
BITS = 24
#: A filter, list or table of met entries of more bytes is not broadcast.
BROADCAST_BYTES = 32 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> F.Column:
    return F.translate(F.coalesce(F.regexp_extract(F.col(url), _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> F.Column:
    return F.coalesce(F.regexp_extract(F.col(url), _PARTS, 2), F.lit(""))


def _canonical(host, path) -> F.Column:
    """Host without ``www.`` and path without closing slashes; query and fragment are gone already."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def default_urls(spark) -> DataFrame:
    """(url): the listed sites, and their numbered pages."""
    each = lambda xs: F.explode(F.array(*[F.lit(x) for x in xs]))
    pages = spark.range(NUMBERS).withColumn("site", each(SITES)).withColumn("lang", each(LANGS))
    pages = pages.select(F.concat(F.lit("http://"), "site", F.lit("/"), "lang", F.lit("/"), F.col("id").cast("string")).alias("url"))
    return pages.unionByName(spark.createDataFrame([(u,) for u in LISTED], "url string"))


def listing(spark, rules=RULES, urls: DataFrame | None = None) -> DataFrame:
    """key, rank (longest rule wins, any rule before the method), rule, verdict.

    ``urls`` has a column ``url``: a URL whose path is ``/`` lists its whole
    site with subdomains, any other its canonical form.
    """
    given = spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string").select(
        F.concat(F.lit("r:"), "host", "path").alias("key"),
        (F.length(F.concat("host", "path")) + 1).cast("long").alias("rank"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    urls = default_urls(spark) if urls is None else urls
    host, path = host_of("url"), path_of("url")
    listed = urls.where((host != "") & host.isNotNull()).select(
        F.when(path.isin("", "/"), F.concat(F.lit("s:"), host)).otherwise(F.concat(F.lit("u:"), _canonical(host, path))).alias("key"),
        F.lit(0).cast("long").alias("rank"),
        F.lit(None).cast("string").alias("rule"),
        F.lit("block").alias("verdict"),
    )
    # Of equal rules with two verdicts, block stands.
    return given.unionByName(listed).groupBy("key", "rank", "rule").agg(F.max("verdict").alias("verdict"))


def _block(key, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key, word: int) -> F.Column:
    """One bit of a 64-bit word, chosen by six bits of a second hash."""
    bit = F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 8 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))


def bloom(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The filter as a table (block, w0..w3), and its number of blocks."""
    blocks = max(1, -(-n * BITS // 256))
    k = F.col("key")
    return keys.groupBy(_block(k, blocks).alias("block")).agg(*[F.bit_or(_mask(k, i)).alias(f"w{i}") for i in range(4)]), blocks


def passed(cand: DataFrame, listed: DataFrame, n: int) -> DataFrame:
    """Candidates that the filter lets through."""
    table, blocks = bloom(listed.select("key"), n)
    k = F.col("key")
    hit = F.lit(True)
    for i in range(4):
        m = _mask(k, i)
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    small = n * BITS // 8 <= BROADCAST_BYTES
    return cand.withColumn("block", _block(k, blocks)).join(F.broadcast(table) if small else table, "block").where(hit).select(*cand.columns)


def candidates(urls: DataFrame, listed: DataFrame, labels: int) -> DataFrame:
    """(host, path, key): the keys that each (host, path) could be listed under."""
    # A rule's path has one of as many lengths, at most, as the longest has characters.
    path_lengths = listed.where("rule is not null").select(F.length(F.regexp_replace("rule", r"^[^/]*", "")).alias("n")).distinct()
    lengths = F.array(*[F.lit(n) for n in sorted(r["n"] for r in path_lengths.collect())]).cast("array<int>")
    suffixes = F.filter(
        F.transform(
            F.sequence(F.lit(1), F.lit(labels)),
            lambda d: F.when(d <= F.size("parts"), F.array_join(F.slice(F.col("parts"), F.greatest(F.size("parts") - d + 1, F.lit(1)), d), ".")),
        ),
        lambda s: s.isNotNull(),
    )
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    by_rule = F.flatten(F.transform("prefixes", lambda p: F.transform("suffixes", lambda s: F.concat(F.lit("r:"), s, p))))
    keys = F.concat(F.array(F.concat(F.lit("u:"), _canonical(F.col("host"), F.col("path")))), F.transform("suffixes", lambda s: F.concat(F.lit("s:"), s)), by_rule)
    return (
        urls.where(F.col("host") != "")
        .withColumn("parts", F.split("host", r"\."))
        .withColumns({"suffixes": suffixes, "prefixes": prefixes})
        .select("host", "path", F.explode(F.array_distinct(keys)).alias("key"))
    )


def decisions(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """For each (host, path) that is listed: the rule (null if the method found it) and verdict."""
    n, size, labels = listed.agg(
        F.count("*"),
        F.coalesce(F.sum(F.length("key") + 60), F.lit(0)),
        F.coalesce(F.max(F.size(F.split("key", r"\."))), F.lit(1)),
    ).first()
    cand = candidates(urls, listed, labels)
    if size <= BROADCAST_BYTES:
        met = passed(cand, listed, n).join(F.broadcast(listed), "key")
    else:
        hits = cut(passed(cand.select("key").distinct(), listed, n).join(listed, "key"), "met")
        weight = hits.agg(F.coalesce(F.sum(F.length("key") + 60), F.lit(0))).first()[0]
        met = cand.join(F.broadcast(hits) if weight <= BROADCAST_BYTES else hits, "key")
    best = F.max(F.struct("rank", "verdict", "rule")).alias("best")
    return met.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, host, path, rule and verdict of every row."""
    split = pages.select(F.col(f"`{key}`").alias("k"), host_of(f"`{url}`").alias("host"), path_of(f"`{url}`").alias("path"))
    found = cut(decisions(split.select("host", "path").distinct(), listed), "decisions").withColumnRenamed("host", "site")
    # No host holds a slash, so the salted rows stay without a partner.
    site = F.when(F.col("host") != "", F.col("host")).otherwise(F.concat(F.lit("/"), (F.monotonically_increasing_id() % 1009).cast("string")))
    return split.withColumn("site", site).join(found, ["site", "path"], "left").select(
        F.col("k").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )

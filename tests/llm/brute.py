"""Brute-force versions of the contract, as plain as they can be."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import tiktoken
import xxhash


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def secrets(text):
    text = text or ""
    assign = [m for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
    access = [m for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    hexes = [m for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    spans = sorted((m.start(), k, m.end()) for k, ms in enumerate((assign, access, hexes)) for m in ms)
    return len(assign), len(access), len(hexes), sha(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans))


def contamination(text, items):
    ws = words(text)
    hit, found = set(), set()
    for name, body in items:
        iw = words(body)
        if name is None or not iw:
            continue
        n = min(13, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(ws) - n + 1):
            if tuple(ws[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(ws), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(ws)


def bpe(text, ranks, pattern):
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    ids = enc.encode_ordinary(text or "")
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def fingerprint(text):
    ws = [w for w in re.split("[\x20\x09-\x0d]+", ascii_lower(text or "")) if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def grouped(pairs, radius=4):
    """pairs of (id, fingerprint) → {row: least id reachable}"""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = defaultdict(lambda: None)
    for i, f in pairs:
        r = root(f)
        if i is not None and (least[r] is None or i < least[r]):
            least[r] = i
    return Counter((i, f"{f:016x}", least[root(f)]) for i, f in pairs)


def topk(rows, k=10):
    """A list, as a repeated query row is answered as often."""
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(ok) if b != a)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return out


def near_sketch(text):
    """Four least hashes and the 1024-bit fingerprint over the set of 5-word shingles, one word at a time."""
    ws = [w for w in re.split("[\x20\x09-\x0d]+", ascii_lower(text or "")) if w]
    shingles = {" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}
    hs = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles], dtype=np.uint64)
    least, wide = [], 0
    for n in range(16):
        x = hs * np.uint64(xxhash.xxh64_intdigest(str(n), 11) | 1)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
        least.append((n, int(x.min())))
        for b in range(64):
            wide |= int(2 * int((x >> np.uint64(b) & np.uint64(1)).sum()) > len(hs)) << (64 * n + b)
    return set(least[:4]), wide


def deduplicated(docs):
    """docs: (unique id, text) → ids that stay: the least of each group, and of linked near copies among these."""
    kept = sorted({c for _, _, c in grouped([(i, fingerprint(t)) for i, t in docs])})
    texts = dict(docs)
    sketches = {i: near_sketch(texts[i]) for i in kept}
    parent = {i: i for i in kept}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(kept):
        for b in kept[n + 1 :]:
            (ka, wa), (kb, wb) = sketches[a], sketches[b]
            if not ka.isdisjoint(kb) and (wa ^ wb).bit_count() <= 170:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {root(i) for i in kept}


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = ascii_lower(re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest[len(host) :])[0]
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def licenses(text):
    ws = words(text)
    at, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        here = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def contained(text, templates, threshold):
    """Labels of the templates that some line contains to the threshold."""
    out = set()
    for label, body in templates:
        t = set(words(body))
        for line in (text or "").split("\n"):
            if len(t & set(words(line))) >= threshold * len(t) - 1e-9:
                out.add(label)
    return out

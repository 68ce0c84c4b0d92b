"""SimHash near-duplicates by pivot distance tables (operator 6).

A fingerprint has a bit set where more than half of the text's 4-word shingle
hashes (XXH64, seed 42) have it. Two fingerprints are linked at ``RADIUS`` or
fewer differing bits; linked fingerprints form components.

Distinct fingerprints are compared, so copies cost nothing. Fingerprints meet
in buckets: of ``n`` blocks of bits at least ``n - 4`` are equal in a linked pair,
so with one table for each choice of ``n - 4`` blocks every linked pair shares a
bucket. Within a bucket the pivot table decides: the Hamming distances of each
member to the reference fingerprints are computed once, a pair is discarded as
soon as two distances to one reference differ by more than the radius (the
triangle inequality), and survivors are verified on the fingerprints.

A bucket gives a spanning forest of its links, never all its pairs. A bucket
of more than ``BUCKET`` members is not gathered: its members go on to the next
round under finer buckets, five for the bits that were free (four or fewer of
them differ, so one fifth is equal). Every round frees fewer bits, and 12 free
bits have no more than ``BUCKET`` values, so rounds end and no link is lost.
Hot buckets are found before they are shuffled, by counts over ``SLOTS`` slots of
the buckets' hashes: what lies in a slot of over ``BUCKET`` rows (and over four
times the mean) is refined where it is; so no task reads a hot bucket.

``deduplicated``, the cleaning stage, goes beyond the four bits, which few copies
with changed words meet. Of the documents that stay, near copies are sought by
a wide fingerprint: ``WIDE`` times 64 bits over the set of 5-word shingles. Two
documents are near copies if they share one of ``SLOTS_NEAR`` least shingle hashes
(documents of similarity 0.8 do but for one in 600) and their wide fingerprints
differ in at most ``NEAR`` bits, which is a similarity of about 0.8 (of pairs of similarity 0.7 about
one in 60 is within). Of linked ones the least id stays. A bucket of over ``NEAR_BUCKET``
documents is not compared as a whole. ``PIVOTS`` of its members serve as references:
a member within ``NEAR`` bits of one is linked to it, so a large group of copies costs
one comparison a member and is not compared within itself. By the triangle
inequality such a member can be linked only to others within twice ``NEAR`` of that
reference, and these two sides meet in tiles of ``CHUNK`` by ``CHUNK``. What is near no
reference goes on under a further shared hash, any of the ``WIDE`` ones (linked
documents share two of them but for one in a billion), and what still lies in a
large bucket after ``LEVELS`` hashes meets in tiles, all against all.

Nulls: a null text, or one without words, has fingerprint zero and is linked
like any other. Rows with null id get a fingerprint and component, but no null
is ever a component's id unless all its ids are null. Repeated rows stay.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.components import components
from tessera.llm.rows import map_texts, numbered
from tessera.session import cut, discard

WORDS, SEED, RADIUS = 4, 42, 4
BUCKET = 4096
SLOTS = 1 << 20
PIVOTS = 16
_CHUNK = 1 << 16

NEAR_WORDS, WIDE, NEAR, SLOTS_NEAR = 5, 16, 170, 4
NEAR_BUCKET, CHUNK, LEVELS = 1024, 4096, 2
#: Near copies differ in no more of the first 64 bits; a cheap first look.
_NEAR_FIRST = 28


def _pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of their numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i), 7) for i in range(n)], dtype=np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The text's 64-bit fingerprint."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - WORDS] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist())),
        dtype=np.uint64,
        count=len(starts),
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


_FACTORS = np.array([xxhash.xxh64_intdigest(str(i), 11) | 1 for i in range(WIDE)], dtype=np.uint64)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """``WIDE`` hashes of each hash."""
    x = hashes[:, None] * _FACTORS
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def sketch(text: bytes | None) -> tuple[list[int], bytes]:
    """The ``WIDE`` least hashes and the wide fingerprint of the text's set of 5-word shingles."""
    words = text.lower().split() if text else []
    runs = [b" ".join(words[i : i + NEAR_WORDS]) for i in range(max(1, len(words) - NEAR_WORDS + 1))]
    hashes = np.unique(np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), dtype=np.uint64, count=len(runs)))
    ones = np.zeros(64 * WIDE, dtype=np.int64)
    least = np.full(WIDE, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        x = _mixed(hashes[at : at + 4096])
        least = np.minimum(least, x.min(axis=0))
        ones += np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return least.view(np.int64).tolist(), np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the fingerprint as a signed long."""

    def make() -> Callable:
        return lambda t: (_signed(fingerprint(t)),)

    return map_texts(docs, make, [("fp", T.LongType())], keys=(key,), text=text)


def _masks(n: int, blocks: int) -> list[int]:
    """Bits of each choice of ``blocks - RADIUS`` out of ``blocks`` blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    part = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in itertools.combinations(part, blocks - RADIUS)]


def _tables(n: int) -> list[int]:
    """Tables for ``n`` fingerprints: the fewest blocks whose keys keep buckets small."""
    blocks = next((b for b in (5, 6, 7, 8) if 64 * (b - RADIUS) / b >= math.log2(max(2, n)) - 2), 8)
    return _masks(n, blocks)


def _finer(mask: int) -> list[int]:
    """The mask with each fifth of its free bits added."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [round(i * len(free) / (RADIUS + 1)) for i in range(RADIUS + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def forest(fps: np.ndarray, table: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (member, root) that join the members of one bucket as their linked pairs do."""
    left = np.arange(len(fps))
    links = []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        front = [root]
        while front and len(left):
            x = front.pop()
            near = left
            for p in range(table.shape[1]):  # discard by coordinate difference
                near = near[np.abs(table[near, p] - table[x, p]) <= radius]
                if len(near) < 64:
                    break
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= radius]  # verify
            if len(near):
                links += [(int(m), root) for m in near]
                front += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)
    return links


def _small_pairs(keys: np.ndarray, fps: np.ndarray, table: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs within buckets of at most ``most`` members; rows are sorted by bucket."""
    a, b = [], []
    for off in range(1, most):
        i = np.flatnonzero(keys[off:] == keys[:-off]) if len(keys) > off else np.zeros(0, dtype=np.int64)
        if not len(i):
            break
        j = i + off
        for p in range(table.shape[1]):
            keep = np.abs(table[i, p] - table[j, p]) <= RADIUS
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(fps[i] ^ fps[j]) <= RADIUS
        a.append(i[keep])
        b.append(j[keep])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, dtype=np.int64),) * 2


#: Buckets of up to this many members are compared all together.
_FEW = 8


def _bucket_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mask, bits, fp), sorted, of whole buckets. Out: links (a, b) with mask null, and
    for buckets that are too large (fp, null, finer mask)."""
    pivots = _pivots()

    def out(a, b, m):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.asarray(a, dtype=np.uint64).view(np.int64)),
                pa.array(np.asarray(b, dtype=np.uint64).view(np.int64)) if b is not None else pa.nulls(n, pa.int64()),
                pa.array(np.asarray(m, dtype=np.uint64).view(np.int64)) if m is not None else pa.nulls(n, pa.int64()),
            ],
            names=["a", "b", "mask"],
        )

    def finer(mask, fps):
        for m in _finer(int(mask)):
            yield out(fps, None, np.full(len(fps), m, dtype=np.uint64))

    def solve(mask, bits, fps):
        """Whole buckets."""
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        group = np.repeat(np.arange(len(starts)), sizes)
        table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)
        few = np.repeat((sizes > 1) & (sizes <= _FEW), sizes)
        if few.any():
            at = np.flatnonzero(few)
            i, j = _small_pairs(group[at], fps[at], table[at], _FEW)
            if len(i):
                yield out(fps[at][i], fps[at][j], None)
        for s, n in zip(starts[sizes > _FEW], sizes[sizes > _FEW]):
            own = slice(s, s + n)
            if n > BUCKET:
                yield from finer(mask[s], fps[own])
            elif links := forest(fps[own], table[own]):
                x = np.array(links)
                yield out(fps[own][x[:, 0]], fps[own][x[:, 1]], None)

    held: list[tuple] = []
    size = 0
    open_mask = open_bits = None  # of a bucket that is too large and still goes on
    for batch in batches:
        mask, bits, fps = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("mask", "bits", "fp"))
        if open_mask is not None:
            more = int(np.argmin(np.append((mask == open_mask) & (bits == open_bits), False)))
            if more:
                yield from finer(open_mask, fps[:more])
                mask, bits, fps = mask[more:], bits[more:], fps[more:]
            if not len(fps):
                continue
            open_mask = None
        if not len(fps):
            continue
        held.append((mask, bits, fps))
        mask, bits, fps = (np.concatenate(x) for x in zip(*held))
        last = int(np.argmax((mask == mask[-1]) & (bits == bits[-1]))) if len(fps) else 0
        if last:
            yield from solve(mask[:last], bits[:last], fps[:last])
        mask, bits, fps = mask[last:], bits[last:], fps[last:]
        held = [(mask, bits, fps)]
        if len(fps) > BUCKET:
            open_mask, open_bits = mask[-1], bits[-1]
            yield from finer(open_mask, fps)
            held = []
    if held:
        yield from solve(*(np.concatenate(x) for x in zip(*held)))


_LINK = "a long, b long, mask long"


def _refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint under the finer masks of its own."""
    for batch in batches:
        mask, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "fp"))
        for own in np.unique(mask):
            here = fps[mask == own]
            for m in _finer(int(own) & (1 << 64) - 1):
                yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(np.full(len(here), _signed(m), dtype=np.int64))], names=["fp", "mask"])


def links(distinct: DataFrame, n: int) -> list[DataFrame]:
    """Links (a, b) among ``n`` distinct fingerprints ``fp``, in one written table for each round."""
    masks = F.array(*[F.lit(_signed(m)) for m in _tables(n)])
    rows, size = distinct.select("fp", F.explode(masks).alias("mask")), n * len(_tables(n))
    rounds = []
    while True:
        slot = F.pmod(F.xxhash64("mask", "bits"), F.lit(SLOTS))
        # Buckets with 12 free bits or fewer cannot be large, so they are not refined.
        open_slot = F.when(F.bit_count("mask") < 52, slot)
        keyed = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp").withColumn("slot", open_slot)
        hot = cut(keyed.where("slot is not null").groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") > max(BUCKET, 4 * size // SLOTS)).select("slot"), "hot")
        over = None if hot.isEmpty() else keyed.join(F.broadcast(hot), "slot", "left_semi")  # a quarter of SLOTS rows at most
        cool = keyed if over is None else keyed.join(F.broadcast(hot), "slot", "left_anti")
        found = cut(cool.select("mask", "bits", "fp").repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp").mapInArrow(_bucket_links, _LINK), "links")
        rounds.append(found)
        left = found.where("mask is not null").select(F.col("a").alias("fp"), "mask")
        if over is not None:
            left = left.unionByName(over.mapInArrow(_refine, "fp long, mask long"))
        rows = cut(left, "refined")
        size = rows.count()
        if not size:
            return rounds


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, fp and component (the least ``key`` that can be reached) of every row."""
    prints = cut(fingerprints(docs, key, text), "prints")
    return grouped_prints(prints, key)


def grouped_prints(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    distinct = cut(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    rounds = links(distinct, distinct.count())
    edges = rounds[0].where("mask is null").select("a", "b")
    for r in rounds[1:]:
        edges = edges.unionByName(r.where("mask is null").select("a", "b"))
    roots = components(edges, "components")
    for r in rounds:
        discard(r)
    # Only fingerprints with links are joined; all others are their own component.
    label = distinct.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = cut(label.groupBy("root").agg(F.min("least").alias("component")), "least")
    by_print = label.join(least, "root").select("fp", "component")
    return prints.join(by_print, "fp").select(key, "fp", "component")


def digests(docs: DataFrame) -> DataFrame:
    return grouped(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def _sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, fp, and what ``sketch`` gives."""

    def make() -> Callable:
        return lambda t: (_signed(fingerprint(t)), *sketch(t))

    fields = [("fp", T.LongType()), ("least", T.ArrayType(T.LongType())), ("wide", T.BinaryType())]
    return map_texts(docs, make, fields, keys=(key,), text=text)


def _whole_buckets(batches: Iterable[pa.RecordBatch], marks: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches, one bucket (rows of equal ``marks``) after the other."""

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in marks]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for s, e in zip(starts, starts[1:]):
            yield batch.slice(s, e - s)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        *whole, last = parts(batch)
        if held and [batch.column(c)[0] for c in marks] != [held[0].column(c)[0] for c in marks]:
            yield pa.concat_batches(held)
            held = []
        if whole:
            yield pa.concat_batches([*held, whole[0]])
            yield from whole[1:]
            held = []
        held.append(last)
    if held:
        yield pa.concat_batches(held)


def _wide_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("wide").to_pylist()), dtype="<u8").reshape(batch.num_rows, WIDE)


def _bits_apart(wide: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(wide ^ one).sum(axis=1, dtype=np.int32)


def _near_in_buckets(kind: T.DataType) -> Callable:
    """Rows (mask, key, tile, side, h, wide), sorted, of whole tiles. Out: links (a, b) between
    the sides, or among all rows where there is one side."""
    arrow = to_arrow_schema(T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))

    def links_of(ids: list, side: np.ndarray, wide: np.ndarray) -> list[tuple]:
        first = np.ascontiguousarray(wide[:, 0])
        both = len(np.unique(side)) > 1
        # Unvisited rows by side; a row meets those of the other side, or of its own where there is but one.
        left = [np.flatnonzero(side == s) for s in (0, 1)] if both else [np.arange(len(ids))]
        found = []
        while all(map(len, left)):
            root, left[0] = int(left[0][0]), left[0][1:]
            front = [(root, 0)]
            while front:
                x, own = front.pop()
                meets = 1 - own if both else 0
                if not len(left[meets]):
                    continue
                near = left[meets][np.bitwise_count(first[left[meets]] ^ first[x]) <= _NEAR_FIRST]
                near = near[_bits_apart(wide[near], wide[x]) <= NEAR]
                if len(near):
                    found += [(ids[m], ids[root]) for m in near.tolist()]
                    front += [(m, meets) for m in near.tolist()]
                    left[meets] = np.setdiff1d(left[meets], near, assume_unique=True)
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for bucket in _whole_buckets(batches, ("mask", "key", "tile")):
            if bucket.num_rows > 1:
                found += links_of(bucket.column("h").to_pylist(), bucket.column("side").to_numpy(zero_copy_only=False), _wide_of(bucket))
            if len(found) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return run


#: What a member of a large bucket is to a reference, or to the whole bucket.
_CORE, _SHELL, _REST = 0, 1, 2


def _around_pivots(schema: T.StructType) -> Callable:
    """Rows (mask, key, salt, place, h, wide), sorted: references have a ``place`` from 0, members -1.
    Out: (mask, key, pivot, role, h, b): a member is core of the first reference within ``NEAR``
    bits (``b`` is that reference), shell of every earlier one within twice as many, or else rest."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _whole_buckets(batches, ("mask", "key", "salt")):
            place = bucket.column("place").to_numpy(zero_copy_only=False)
            wide, ids = _wide_of(bucket), bucket.column("h").to_pylist()
            members, pivots = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
            if not len(members):
                continue
            apart = np.stack([_bits_apart(wide[members], wide[p]) for p in pivots], axis=1)
            near = apart <= NEAR
            core = np.where(near.any(axis=1), near.argmax(axis=1), len(pivots))
            rows = [(int(place[pivots[c]]), _CORE, ids[m], ids[pivots[c]]) for m, c in zip(members, core) if c < len(pivots)]
            rows += [(-1, _REST, ids[m], None) for m, c in zip(members, core) if c == len(pivots)]
            shell = (apart <= 2 * NEAR) & (np.arange(len(pivots)) < core[:, None])
            rows += [(int(place[pivots[p]]), _SHELL, ids[members[m]], None) for m, p in zip(*np.nonzero(shell))]
            same = [[bucket.column(c)[0].as_py()] * len(rows) for c in ("mask", "key")]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip([*same, *zip(*rows)], arrow)], schema=arrow)

    return run


def _tile(pivot: Column, one: Column, other: Column) -> Column:
    """A number for a tile of two chunks, the lesser bits for the chunks."""
    return ((pivot + 1) * (1 << 50) + one * (1 << 25) + other).cast("long")


def _chunks(n: str) -> Column:
    return F.ceil(F.col(n) / CHUNK).cast("long")


def _sides_in_tiles(around: DataFrame) -> DataFrame:
    """Core against shell of each reference: (mask, key, tile, side, h)."""
    of = ["mask", "key", "pivot"]
    sizes = around.where(F.col("role") != _REST).groupBy(*of).agg(F.count_if(F.col("role") == _CORE).alias("n0"), F.count_if(F.col("role") == _SHELL).alias("n1"))
    both = around.where(F.col("role") != _REST).join(sizes.where("n0 > 0 and n1 > 0"), of)
    is_core = F.col("role") == _CORE
    own = F.pmod(F.xxhash64("h", F.lit(3)), F.when(is_core, _chunks("n0")).otherwise(_chunks("n1")))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.when(is_core, _chunks("n1")).otherwise(_chunks("n0")) - 1))
    dealt = both.withColumn("own", own).withColumn("other", meets)
    tile = F.when(is_core, _tile(F.col("pivot"), F.col("own"), F.col("other"))).otherwise(_tile(F.col("pivot"), F.col("other"), F.col("own")))
    return dealt.select("mask", "key", tile.alias("tile"), F.col("role").alias("side"), "h")


def _all_in_tiles(rest: DataFrame) -> DataFrame:
    """All members of each bucket (mask, key) against all: (mask, key, tile, side, h)."""
    sizes = rest.groupBy("mask", "key").agg(F.count("*").alias("m")).where("m > 1")
    own = F.pmod(F.xxhash64("h", F.lit(3)), _chunks("m"))
    dealt = rest.join(sizes, ["mask", "key"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), _chunks("m") - 1)))
    tile = _tile(F.lit(-1), F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select("mask", "key", tile.alias("tile"), (F.col("own") > F.col("other")).cast("int").alias("side"), "h")


def near_links(sketches: DataFrame) -> DataFrame:
    """(a, b): links that join rows (h, least, wide), unique in h, as their near pairs do."""
    kind = sketches.schema["h"].dataType
    wide, least = sketches.select("h", "wide"), sketches.select("h", "least")
    link = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    around_schema = T.StructType([T.StructField(c, T.LongType()) for c in ("mask", "key")] + [T.StructField(c, T.IntegerType()) for c in ("pivot", "role")] + [T.StructField("h", kind), T.StructField("b", kind)])

    def under(rows: DataFrame, hashes: Column) -> DataFrame:
        return rows.select("*", F.posexplode(hashes).alias("slot", "value")).withColumn("bit", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot")))

    def solved(rows: DataFrame) -> DataFrame:
        dealt = rows.join(wide, "h").repartition("mask", "key", "tile").sortWithinPartitions("mask", "key", "tile", "side", "h")
        return cut(dealt.select("mask", "key", "tile", "side", "h", "wide").mapInArrow(_near_in_buckets(kind), link), "near-links")

    # A bucket is a set of slots (mask) and a digest of their hashes that does not depend on their order.
    digest = F.xxhash64("slot", "value")
    rows = under(least, F.slice("least", 1, SLOTS_NEAR)).select(F.col("bit").alias("mask"), digest.alias("key"), "h")
    found = []
    for level in range(LEVELS):
        sizes = cut(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
        held = rows.join(sizes, ["mask", "key"])
        small = held.where(F.col("n") <= NEAR_BUCKET).select("mask", "key", F.lit(0).cast("long").alias("tile"), F.lit(0).alias("side"), "h")
        if sizes.where(F.col("n") > NEAR_BUCKET).isEmpty():
            found.append(solved(small))
            break
        salts = F.ceil(F.col("n") / NEAR_BUCKET).cast("long")
        large = cut(held.where(F.col("n") > NEAR_BUCKET).join(wide, "h").select("mask", "key", salts.alias("salts"), "h", "wide"), "large")
        place = F.pmod(F.xxhash64("h"), F.lit(PIVOTS)).cast("int")
        pivots = large.groupBy("mask", "key", place.alias("place")).agg(F.min(F.struct(F.xxhash64("h", F.lit(7)), "h", "wide", "salts")).alias("p"))
        pivots = pivots.select("mask", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.salts") - 1)).alias("salt"), "place", "p.h", "p.wide")
        members = large.select("mask", "key", F.pmod(F.xxhash64("h", F.lit(1)), F.col("salts")).alias("salt"), F.lit(-1).alias("place"), "h", "wide")
        dealt = members.unionByName(pivots).repartition("mask", "key", "salt").sortWithinPartitions("mask", "key", "salt", "place", "h")
        around = cut(dealt.mapInArrow(_around_pivots(around_schema), around_schema), "around")
        found.append(around.where("b is not null").select(F.col("h").alias("a"), "b"))
        rest = around.where(F.col("role") == _REST).select("mask", "key", "h")
        tiles = small.unionByName(_sides_in_tiles(around))
        if level == LEVELS - 1:
            tiles = tiles.unionByName(_all_in_tiles(rest))
        found.append(solved(tiles))
        further = under(rest.join(least, "h"), F.col("least")).where(F.col("mask").bitwiseAND(F.col("bit")) == 0)
        rows = further.select(F.col("mask").bitwiseOR(F.col("bit")).alias("mask"), F.col("key").bitwiseXOR(digest).alias("key"), "h").distinct()
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group and, of these, one of linked near copies; the same columns.

    The least id stays. Where ids are null or repeated, so that an id names
    several rows of a group, one of those rows (the least by content) stays.
    """
    prints = cut(_sketches(docs, "doc_id", "text"), "prints")
    kept = grouped_prints(prints.select("doc_id", "fp")).where(F.col("doc_id").eqNullSafe(F.col("component"))).select("doc_id", "fp")
    kept = cut(kept, "kept")
    n, ids = kept.agg(F.count("*"), F.countDistinct("doc_id")).first()
    plain, at = numbered(docs)
    if n == ids:
        # Written, as near_links reads them for each round and each size of bucket.
        ones = cut(prints.join(kept.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("h"), "least", "wide"), "ones")
        copies = cut(components(near_links(ones), "near").select(F.col("a").alias("kept")), "copies")
        stay = kept.select(F.col("doc_id").alias("kept")).join(copies, "kept", "left_anti")
        one = plain.join(stay, F.col(at["doc_id"]) == F.col("kept"), "left_semi")
    else:
        one = _one_of_each(plain, prints.select("doc_id", "fp"), at["doc_id"], at["text"])
    return one.toDF(*docs.columns)


def _one_of_each(docs: DataFrame, prints: DataFrame, key: str, text: str) -> DataFrame:
    """The slower way for null or repeated ids: rows take their component through their text's hash."""
    whole = F.coalesce(F.col(text), F.lit(""))
    h = F.sha2(whole, 256)
    texts = docs.select(h.alias("h"), whole.alias("t")).groupBy("h").agg(F.first("t").alias("t"))
    by_text = cut(_sketches(texts, "h", "t"), "by-text")
    by_print = grouped_prints(prints).select("fp", "component").distinct()
    of = by_text.join(by_print, "fp").select("h", "component")
    rows = docs.withColumn("h", h).join(of, "h").where(F.col(key).eqNullSafe(F.col("component")))
    # A component without any id is as good as one id: its least text stays.
    label = F.coalesce(F.col("component").cast("string"), F.lit("null"))
    best = cut(rows.groupBy(label.alias("group")).agg(F.min("h").alias("best")), "best")
    ones = cut(by_text.join(best.select(F.col("best").alias("h")), "h", "left_semi").select("h", "least", "wide"), "ones")
    copies = cut(components(near_links(ones), "near").select(F.col("a").alias("h")), "copies")
    one = rows.join(best, (F.col("h") == F.col("best")) & (label == F.col("group")), "left_semi").join(copies, "h", "left_anti")
    return one.dropDuplicates(["h", key]).select(*docs.columns)

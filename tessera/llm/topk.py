"""Exact top-k inner-product search by MaxScore (operator 5).

Components are the terms: a vector's component in dimension d is its posting
in list d. Vectors are held in shards; each shard keeps its postings by
dimension and, for each dimension, the least and largest value, so a query
knows the most that any posting of a term can add. Terms are ordered by how
far their bounds reach; those whose joint bound can still lift a vector over
the query's current k-th score are essential, the rest are not. Essential
postings are traversed as columns; the others are probed only for vectors
that stay competitive. The best of each tile are merged in one window.

The work is dealt in tiles of one block of queries and one piece of the
vectors, all in one exchange whatever the number of blocks; nothing is
collected but counts and a seed of ``SEED`` vectors. The seed gives every query
a first floor, and its first ``CELLS`` members order a tile's vectors by nearest
member, so that a shard holds like vectors and its bounds are narrow.

Every row counts. A query's own row is found by id and components: of the rows
that equal the query in both, one is left out. Rows of equal id that differ in
components are rows like any other; a repeated query row is answered as often.

Nulls: vectors that are null or hold null or non-finite components, and rows
with null id, take no part. Shorter vectors are taken as ending in zeros.
Scores beyond 2**53 are computed in Python integers and kept within 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
#: Queries and vectors of one tile, vectors of one shard, and partitions at most.
QUERY_BLOCK = 4096
PIECE = 65_536
LEAST_PIECE = 4096
SHARD = 4096
PARTITIONS = 50_000
#: Vectors that give the first floors, and how many of them order the tiles.
SEED = 1024
CELLS = 64
_LIMIT = 2.0**53


class Shard:
    """Vectors of one shard with postings by dimension and their bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.columns = np.ascontiguousarray(vectors.T)  # dimension x vector
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def reached(self, queries: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """The queries whose floor some vector of the shard might reach."""
        return np.flatnonzero(np.maximum(queries * self.low, queries * self.high).sum(axis=1) >= floors)

    def search(self, query: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of every vector whose score is at least ``floor``."""
        a, b = query * self.low, query * self.high
        most, least = np.maximum(a, b), np.minimum(a, b)
        order = np.argsort(least - most, kind="stable")
        rest = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0.0]])
        # Essential: the fewest terms without which no vector could reach the floor.
        slack = np.cumsum((most - least)[order][::-1])[::-1]
        essential = int(np.searchsorted(-(slack + least.sum()), -floor, side="right")) if np.isfinite(floor) else len(order)
        done = min(len(order), max(8, essential))
        score = query[order[:done]] @ self.columns[order[:done]]
        alive = np.arange(len(self.ids))
        while done < len(order):
            keep = score + rest[done] >= floor
            alive, score = alive[keep], score[keep]
            if not len(alive):
                return alive, score
            step = order[done : done + 8]
            score = score + query[step] @ self.columns[np.ix_(step, alive)]
            done += len(step)
        fit = score >= floor
        return alive[fit], score[fit]


class Best:
    """A tile's best (score, smaller id first on ties) for each query, its own row among them."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, seed: np.ndarray, k: int):
        self.k, self.own, self.queries = k, own, queries
        n = len(own)
        self.ids = [np.zeros(0, dtype=np.int64)] * n
        self.scores = [np.zeros(0)] * n
        self.same = [np.zeros(0, dtype=bool)] * n
        self.floors = np.full(n, -np.inf)
        if len(seed) >= k:
            first = queries @ seed.T
            self.floors = np.partition(first, len(seed) - k, axis=1)[:, len(seed) - k]
        self.reach = np.abs(seed).max(axis=0, initial=0.0)
        self.big: dict[int, list[tuple[int, int, bool]]] = {}

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray, same: np.ndarray) -> None:
        if len(ids):
            ids, scores, same = (np.concatenate(x) for x in ((self.ids[q], ids), (self.scores[q], scores), (self.same[q], same)))
            best = np.lexsort((ids, -scores))[: self.k]
            self.ids[q], self.scores[q], self.same[q] = ids[best], scores[best], same[best]
            if len(best) == self.k:
                self.floors[q] = max(self.floors[q], self.scores[q][-1])

    def search(self, ids: np.ndarray, values: np.ndarray, seed: np.ndarray) -> None:
        """Take in a piece of the vectors."""
        reach = np.maximum(np.abs(values).max(axis=0, initial=0.0), self.reach)
        small = np.abs(self.queries) @ reach < _LIMIT
        for q in np.flatnonzero(~small):
            self._exact(int(q), ids, values)
        centres = seed[:CELLS]
        cell = (values @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1) if len(centres) else np.zeros(len(ids), dtype=int)
        order = np.lexsort((ids, cell))
        plain = np.flatnonzero(small)
        for at in range(0, len(ids), SHARD):
            here = order[at : at + SHARD]
            shard = Shard(ids[here], values[here])
            for q in plain[shard.reached(self.queries[plain], self.floors[plain])]:
                places, scores = shard.search(self.queries[q], self.floors[q])
                found = shard.ids[places]
                same = found == self.own[q]
                if same.any():
                    same[same] = (shard.columns[:, places[same]].T == self.queries[q]).all(axis=1)
                self.add(int(q), found, scores, same)

    def _exact(self, q: int, ids: np.ndarray, values: np.ndarray) -> None:
        """Scores in Python integers, for components too large for doubles."""
        asked = [int(x) for x in self.queries[q]]
        mine = self.big.get(q, []) + [(sum(a * int(y) for a, y in zip(asked, v)), i, bool(i == self.own[q] and (v == self.queries[q]).all())) for i, v in zip(ids.tolist(), values)]
        self.big[q] = sorted(mine, key=lambda x: (-x[0], x[1]))[: self.k]

    def rows(self) -> Iterator[tuple[int, int, int, bool]]:
        """Query's place, vector's id, score, and whether the row equals the query's."""
        for q in range(len(self.own)):
            yield from ((q, int(i), int(s), bool(m)) for i, s, m in zip(self.ids[q], self.scores[q], self.same[q]))
            yield from ((q, i, max(-(2**63), min(2**63 - 1, s)), m) for s, i, m in self.big.get(q, ()))


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column, ``width`` wide."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and lengths.min() == lengths.max() == width:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


def components(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, x): every usable row with its components as whole doubles."""
    x = F.transform(F.col(f"`{column}`").cast("array<double>"), lambda v: F.floor(v * SCALE).cast("double"))
    whole = F.col(f"`{column}`").isNotNull() & ~F.exists(F.col(f"`{column}`").cast("array<double>"), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(whole & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("id"), x.alias("x"))


_FOUND = "query_id long, h1 long, h2 long, copies long, vec_id long, score long, same boolean"


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score. Both sides as ``components`` makes them."""
    spark = vectors.sparkSession
    asked = queries.groupBy("id", "x").agg(F.count("*").alias("copies"))
    n_queries = asked.count()
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    width = max(width, queries.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0])
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    pieces = max(1, -(-n // PIECE), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_PIECE)))
    tiles = blocks * pieces
    rows = vectors.orderBy(F.xxhash64("id", "x"), "id").limit(SEED).select("x").toArrow()["x"]  # SEED rows
    held = spark.sparkContext.broadcast(_dense(rows.combine_chunks(), width) if len(rows) else np.zeros((0, width)))

    def dealt(df, kind, tile, copies):
        return df.select(F.explode(tile).alias("tile"), F.lit(kind).alias("kind"), "id", "x", copies.alias("copies"))

    # The scan's partition is part of the hash, so copies of one row spread over the pieces.
    piece = F.pmod(F.xxhash64("id", "x", F.spark_partition_id()), F.lit(pieces)).cast("int")
    block = F.pmod(F.xxhash64("id", "x"), F.lit(blocks)).cast("int")
    every = dealt(asked, 0, F.sequence(block * pieces, block * pieces + (pieces - 1)), F.col("copies")).unionByName(
        dealt(vectors, 1, F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * pieces + piece), F.lit(0).cast("long"))
    )
    placed = every.repartitionById(min(tiles, PARTITIONS), F.col("tile") % min(tiles, PARTITIONS)).sortWithinPartitions("tile", "kind", "id")
    hashed = placed.select("tile", "kind", "id", "x", "copies", F.when(F.col("kind") == 0, F.xxhash64("x")).alias("h1"), F.when(F.col("kind") == 0, F.xxhash64(F.lit(1), "x")).alias("h2"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = held.value
        for asked_rows, pieces_of in _tiles(batches, width):
            own, h1, h2, copies, values = asked_rows
            best = Best(own, values, seed, k + 1)
            for ids, x in pieces_of:
                best.search(ids, x, seed)
            out = [(int(own[q]), int(h1[q]), int(h2[q]), int(copies[q]), i, s, m) for q, i, s, m in best.rows()]
            if out:
                *longs, same = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in longs] + [pa.array(same, type=pa.bool_())], names=["query_id", "h1", "h2", "copies", "vec_id", "score", "same"])

    found = hashed.mapInArrow(run, _FOUND)
    one = Window.partitionBy("query_id", "h1", "h2")
    ranked = found.withColumn("n", F.row_number().over(one.orderBy(F.desc("score"), "vec_id", F.desc("same")))).where(F.col("n") <= k + 1)
    ranked = ranked.withColumn("own", F.min(F.when(F.col("same"), F.col("n"))).over(one))
    rank = F.when(F.col("own") < F.col("n"), F.col("n") - 1).otherwise(F.col("n"))
    left = ranked.where(~F.col("n").eqNullSafe(F.col("own"))).select("query_id", rank.alias("rank"), "vec_id", "score", "copies").where(F.col("rank") <= k)
    return left.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("col")


def _tiles(batches: Iterable[pa.RecordBatch], width: int):
    """The queries of each tile, and its vectors in pieces of bounded size; a tile without queries is passed over.

    Rows come sorted by tile, queries first.
    """

    def parts():
        """Runs of rows of one tile and kind."""
        for batch in batches:
            if not batch.num_rows:
                continue
            tile, kind = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tile", "kind"))
            mark = tile * 2 + kind
            cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
            for a, b in zip(cuts, cuts[1:]):
                yield int(tile[a]), int(kind[a]), batch.slice(a, b - a)

    stream = parts()
    ahead = next(stream, None)

    def asked(tile):
        nonlocal ahead
        got = []
        while ahead is not None and ahead[:2] == (tile, 0):
            b = ahead[2]
            got.append([b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "h1", "h2", "copies")] + [_dense(b.column("x"), width)])
            ahead = next(stream, None)
        return [np.concatenate(x) for x in zip(*got)]

    def vectors(tile):
        nonlocal ahead
        ids, values, size = [], [], 0
        while ahead is not None and ahead[0] == tile:
            b = ahead[2]
            ids.append(b.column("id").to_numpy(zero_copy_only=False))
            values.append(_dense(b.column("x"), width))
            size += b.num_rows
            ahead = next(stream, None)
            if size >= PIECE:
                yield np.concatenate(ids), np.concatenate(values)
                ids, values, size = [], [], 0
        if size:
            yield np.concatenate(ids), np.concatenate(values)

    while ahead is not None:
        tile = ahead[0]
        queries = asked(tile)
        if queries:
            yield queries, vectors(tile)
        while ahead is not None and ahead[0] == tile:
            ahead = next(stream, None)

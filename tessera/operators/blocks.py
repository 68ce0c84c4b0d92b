"""Exact top-k of inner products, dealt in tiles of a block of queries and a piece of the corpus.

Rows are dealt by id, never by term, so a frequent term is no hot key and
nothing is left out: a tile holds the postings of its piece and adds up, for
each of its queries, the postings of the query's terms. What leaves a tile is
at most k rows for each query; pairs are never made. All tiles are one
exchange whatever the number of blocks, and their sizes are bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Values (postings, or components of vectors) of the queries and of the corpus in one tile; partitions at most.
QUERY_VALUES, PIECE_VALUES, LEAST_PIECE_VALUES = 1 << 20, 1 << 22, 1 << 18
PARTITIONS = 50_000
ROUND = 6


def deal(queries: DataFrame, corpus: DataFrame, payload: list[str], values: tuple[int, int]) -> DataFrame:
    """Rows (tile, kind, qid, cid, *payload), each tile whole in its partition, queries first.

    ``values``: how many values both sides hold, by which the tiles are sized.
    """
    blocks = max(1, -(-values[0] // QUERY_VALUES))
    pieces = max(1, -(-values[1] // PIECE_VALUES), min(corpus.sparkSession.sparkContext.defaultParallelism, -(-values[1] // LEAST_PIECE_VALUES)))
    block, piece = (F.pmod(F.xxhash64("id"), F.lit(n)).cast("int") for n in (blocks, pieces))
    of_query = F.sequence(block * pieces, block * pieces + (pieces - 1))
    of_corpus = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * pieces + piece)
    none = lambda df: F.lit(None).cast(df.schema["id"].dataType)
    asked = queries.select(F.explode(of_query).alias("tile"), F.lit(0).alias("kind"), F.col("id").alias("qid"), none(corpus).alias("cid"), *payload)
    held = corpus.select(F.explode(of_corpus).alias("tile"), F.lit(1).alias("kind"), none(queries).alias("qid"), F.col("id").alias("cid"), *payload)
    n = min(blocks * pieces, PARTITIONS)
    return asked.unionByName(held).repartitionById(n, F.col("tile") % n).sortWithinPartitions("tile", "kind")


def in_tiles(dealt: DataFrame, search: Callable) -> DataFrame:
    """(source1_id, candidate_id, score): what ``search(queries, pieces)`` yields for each tile.

    ``queries`` is one batch, ``pieces`` an iterator of batches of the corpus.
    """
    schema = T.StructType(
        [T.StructField("source1_id", dealt.schema["qid"].dataType), T.StructField("candidate_id", dealt.schema["cid"].dataType), T.StructField("score", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for queries, pieces in _tiles(batches):
            for found in search(queries, pieces):
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(found, arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of rows of one tile and kind."""
    for batch in batches:
        if not batch.num_rows:
            continue
        tile, kind = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tile", "kind"))
        mark = tile * 2 + kind
        cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(tile[a]), int(kind[a]), batch.slice(a, b - a)


def _tiles(batches: Iterable[pa.RecordBatch]):
    runs = _runs(batches)
    ahead = next(runs, None)

    def take(tile: int, kind: int):
        nonlocal ahead
        while ahead is not None and ahead[:2] == (tile, kind):
            own = ahead[2]
            ahead = next(runs, None)
            yield own

    while ahead is not None:
        tile = ahead[0]
        asked = list(take(tile, 0))
        if asked:
            yield pa.concat_batches(asked), take(tile, 1)
        for _ in take(tile, 1):  # of a tile without queries
            pass


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where each row's begin (and the last end)."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Postings:
    """An inverted index of one piece of the corpus."""

    def __init__(self, ids: list, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.place = np.empty(self.n, dtype=np.int64)  # in the order of ids
        self.place[sorted(range(self.n), key=ids.__getitem__)] = np.arange(self.n)
        doc = np.repeat(np.arange(self.n), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.terms, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(terms))
        self.doc, self.weights = doc[order], weights[order]

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The inner product of a query with every row of the piece."""
        if not len(self.terms):
            return np.zeros(self.n)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        hit = self.terms[at] == terms
        at, weights = at[hit], weights[hit]
        size = self.first[at + 1] - self.first[at]
        flat = np.repeat(self.first[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.doc[flat], weights=np.repeat(weights, size) * self.weights[flat], minlength=self.n)

    def best(self, score: np.ndarray, allowed: np.ndarray | None, k: int) -> np.ndarray:
        """Places of the k best positive rounded scores, smaller ids first on ties."""
        score = np.round(score, ROUND)
        near = np.flatnonzero(score > 0 if allowed is None else (score > 0) & allowed)
        if len(near) > k:
            near = near[score[near] >= -np.partition(-score[near], k - 1)[k - 1]]
        return near[np.lexsort((self.place[near], -score[near]))[:k]]


def _search_terms(k: int, by: bool, queries: pa.RecordBatch, pieces: Iterable[pa.RecordBatch]):
    names = queries.column("qid").to_pylist()
    terms, starts = _flat(queries.column("t"))
    weights = _flat(queries.column("w"))[0]
    groups = queries.column("by").to_pylist() if by else None

    def answered(held: list[pa.RecordBatch]):
        piece = pa.concat_batches(held)
        t, begin = _flat(piece.column("t"))
        index = Postings(piece.column("cid").to_pylist(), begin, t, _flat(piece.column("w"))[0])
        of = np.array(piece.column("by").to_pylist(), dtype=object) if by else None
        found: tuple[list, list, list] = ([], [], [])
        for q, name in enumerate(names):
            own = slice(starts[q], starts[q + 1])
            score = index.scores(terms[own], weights[own])
            best = index.best(score, of == groups[q] if by else None, k)
            found[0].extend([name] * len(best))
            found[1].extend(index.ids[i] for i in best)
            found[2].extend(score[best].tolist())
        return found

    held, size = [], 0
    for batch in pieces:
        held.append(batch)
        size += len(batch.column("t").flatten())
        if size >= PIECE_VALUES:
            yield answered(held)
            held, size = [], 0
    if held:
        yield answered(held)


def top_terms(vectors: DataFrame, k: int, by: bool = False) -> DataFrame:
    """(source1_id, candidate_id, score): for each query its k best of each piece, and so of the corpus.

    ``vectors``: side (0: query, 1: corpus), id, t (term hashes), w (weights) and,
    if asked for, ``by``, which has to be equal on both sides.
    """
    sizes = {r["side"]: r["n"] for r in vectors.groupBy("side").agg(F.sum(F.size("t")).alias("n")).collect()}  # two rows
    side = lambda n: vectors.where(F.col("side") == n)
    payload = ["t", "w", *(["by"] if by else [])]
    return in_tiles(deal(side(0), side(1), payload, (sizes.get(0) or 0, sizes.get(1) or 0)), partial(_search_terms, k, by))


def _search_dense(k: int, queries: pa.RecordBatch, pieces: Iterable[pa.RecordBatch]):
    names = queries.column("qid").to_pylist()
    asked = queries.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
    best: list[list[tuple[float, object]]] = [[] for _ in names]
    for batch in pieces:
        ids = batch.column("cid").to_pylist()
        v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        for at in range(0, len(ids), 4096):
            scores = np.round(v[at : at + 4096] @ asked.T, ROUND)
            for j, own in enumerate(names):
                s = scores[:, j]
                floor = best[j][-1][0] if len(best[j]) == k else -np.inf
                if len(s) > k + 1:  # one more, as the row's own id may be among them
                    floor = max(floor, -np.partition(-s, k)[k])
                near = [(float(s[x]), ids[at + x]) for x in np.flatnonzero(s >= floor)]
                best[j] = sorted(best[j] + [p for p in near if p[1] != own], key=lambda p: (-p[0], p[1]))[:k]
    yield (
        [own for own, mine in zip(names, best) for _ in mine],
        [c for mine in best for _, c in mine],
        [s for mine in best for s, _ in mine],
    )


def top_dense(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """As ``top_terms`` for (id, v) with vectors of one width; a row's own id is left out."""
    n, m, width = (
        queries.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0],
        *corpus.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first(),
    )
    return in_tiles(deal(queries, corpus, ["v"], (n * width, m * width)), partial(_search_dense, k))

"""Top-k of inner products within probed cells, as products of matrices.

The corpus is dealt once, by id, so a full cell is no hot key; in its piece a task
groups the rows by cell and multiplies each group with the queries that probe it.
Queries are written once to the shared folder and read there by every task
(``top``); where Arrow cannot read that folder both sides meet in tiles (``blocks``).
At most k rows for each query leave a piece; pairs are never made.
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

from tessera.operators.blocks import LEAST_PIECE_VALUES, PIECE_VALUES, ROUND, deal, in_tiles
from tessera.operators.postings import _shared, reachable
from tessera.session import cut

#: Rows of a piece, and queries, in one product.
ROWS, QUERIES = 4096, 1024


def _matrix(rows: pa.RecordBatch | pa.Table, column: str = "v") -> np.ndarray:
    flat = rows.column(column).combine_chunks() if isinstance(rows, pa.Table) else rows.column(column)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


def nearest(rows: DataFrame, centres: list[list[float]], probe: int) -> DataFrame:
    """(id, v, cells) of rows (id, v): the ``probe`` nearest centres, nearest first, the lower number on ties."""
    schema = T.StructType([*rows.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array(centres)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch)
            far = np.stack([((v - x) ** 2).sum(axis=1) for x in c], axis=1)
            near = np.argsort(far, axis=1, kind="stable")[:, :probe].astype(np.int32)
            ends = np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], schema=arrow)

    return rows.mapInArrow(run, schema)


class Piece:
    """Some rows of the corpus, in the order of their cells."""

    def __init__(self, rows: pa.RecordBatch | pa.Table):
        cell = _matrix(rows, "cells")[:, 0]
        order = np.argsort(cell, kind="stable")
        self.v = _matrix(rows)[order]
        self.ids, code = np.unique(rows.column("id").to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column("id").to_numpy(), return_inverse=True)
        self.code = code[order]  # in the order of ids
        self.cells, first = np.unique(cell[order], return_index=True)
        self.first = np.append(first, len(cell))

    def best(self, names: np.ndarray, v: np.ndarray, cells: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place in ``ids``, score) of each query's k best in its cells, smaller ids first on ties; its own id is left out."""
        at = np.minimum(np.searchsorted(self.ids, names), len(self.ids) - 1)
        own = np.where(self.ids[at] == names, at, -1)
        query, place, score = (np.empty(0, dtype=d) for d in (np.int64, np.int64, np.float64))
        floor = np.full(len(names), -np.inf)
        for c, a, b in zip(self.cells, self.first, self.first[1:]):
            asking = np.flatnonzero((cells == c).any(axis=1))
            if not len(asking):
                continue
            for begin in range(a, b, ROWS):
                end = min(begin + ROWS, b)
                s = np.round(v[asking] @ self.v[begin:end].T, ROUND)
                least = floor[asking]
                if end - begin > k + 1 and np.isneginf(least).any():  # one more, as the row's own id may be among them
                    least = np.maximum(least, -np.partition(-s, k, axis=1)[:, k])
                i, j = np.nonzero(s >= least[:, None])
                q, p, x = asking[i], self.code[begin + j], s[i, j]
                other = p != own[q]
                query, place, score = (np.concatenate(z) for z in ((query, q[other]), (place, p[other]), (score, x[other])))
                order = np.lexsort((place, -score, query))
                query, place, score = query[order], place[order], score[order]
                n = np.arange(len(query)) - np.searchsorted(query, query)
                kept = n < k
                query, place, score, n = query[kept], place[kept], score[kept], n[kept]
                floor[query[n == k - 1]] = score[n == k - 1]
        return query, place, score


def _answers(piece: Piece, queries: pa.RecordBatch, k: int, ident: str) -> tuple[list, list, list]:
    names = queries.column(ident).to_numpy(zero_copy_only=False)
    query, place, score = piece.best(names, _matrix(queries), _matrix(queries, "cells"), k)
    return names[query].tolist(), piece.ids[place].tolist(), score.tolist()


def _in_tile(k: int, queries: pa.RecordBatch, pieces: Iterable[pa.RecordBatch]):
    for batch in pieces:
        if batch.num_rows:
            yield _answers(Piece(batch.rename_columns(["id" if c == "cid" else c for c in batch.schema.names])), queries, k, "qid")


def _search(queries: str, k: int, schema: T.StructType) -> Callable:
    arrow = to_arrow_schema(schema)

    def answered(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = Piece(pa.Table.from_batches(held))
        for batch in _shared(queries).to_batches(columns=["id", "v", "cells"], batch_size=QUERIES):
            if batch.num_rows:
                found = _answers(piece, batch, k, "id")
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(found, arrow)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column("v").flatten())
            if size >= 2 * PIECE_VALUES:
                yield from answered(held)
                held, size = [], 0
        if held:
            yield from answered(held)

    return run


def top(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(source1_id, candidate_id, score) of rows (id, v, cells): each query's k best of each piece among the rows whose first cell it probes."""
    spark = corpus.sparkSession
    size = lambda df: df.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0]
    values = size(corpus)
    if not reachable(spark):
        return in_tiles(deal(queries, corpus, ["v", "cells"], (size(queries), values)), partial(_in_tile, k))
    schema = T.StructType([T.StructField("source1_id", queries.schema["id"].dataType), T.StructField("candidate_id", corpus.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    pieces = max(1, -(-values // PIECE_VALUES), min(spark.sparkContext.defaultParallelism, -(-values // LEAST_PIECE_VALUES)))
    dealt = corpus.repartitionById(pieces, F.pmod(F.xxhash64("id"), F.lit(pieces)).cast("int"))
    return dealt.mapInArrow(_search(cut(queries, "queries")._tessera_path, k, schema), schema)

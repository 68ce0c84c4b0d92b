"""Byte-level BPE encoding and decoding (operator 4).

Every match of the pre-token pattern is encoded by itself, so a pre-token's
ids depend on nothing else. Each task keeps a bounded memo from pre-token to
its ids (as little-endian unsigned 32-bit bytes); pre-tokens that the memo
lacks go to the ``tokenizers`` library in one call per Arrow batch. A text's
ids are then one join of bytes, and decoding is one join over the byte table
that reverses the printable stand-ins of the vocabulary.

Nulls: a null text is the empty text: no ids, no bytes. Bytes that are no UTF-8
are taken as U+FFFD. Special tokens in a text are ordinary text. Repeated rows
give repeated results; null keys stay. Very long texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.rows import decoded, utf8

#: Pre-tokens that a task remembers before it starts its memo anew.
MEMO = 400_000


def _stand_ins() -> dict[str, int]:
    """From a printable stand-in of a byte-level vocabulary to its byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encoder and decoder over one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, json_path: str, pattern: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(json_path)
        self._tok.encode_special_tokens = True
        self._split = regex.compile(pattern)
        self._memo: dict[str, bytes] = {}
        self._limit = memo
        back = _stand_ins()
        size = self._tok.get_vocab_size(with_added_tokens=False)
        self.pieces = [b""] * size
        for piece, i in self._tok.get_vocab(with_added_tokens=False).items():
            if all(c in back for c in piece):
                self.pieces[i] = bytes(back[c] for c in piece)

    def ids_bytes(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._split.findall(t) for t in texts]
        memo = self._memo
        if len(memo) > self._limit:
            memo.clear()
        new = list({p for ps in cut for p in ps if p not in memo})
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            for p, e in zip(part, self._tok.encode_batch_fast(part, add_special_tokens=False)):
                memo[p] = np.array(e.ids, dtype="<u4").tobytes()
        get = memo.__getitem__
        return [b"".join(map(get, ps)) for ps in cut]

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of ids; characters that ids split come out whole once joined."""
        return b"".join(map(self.pieces.__getitem__, ids))

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Start and end of each id in code points.

        An id that holds only part of a character spans that whole character.
        """
        ends = np.cumsum([len(self.pieces[i]) for i in ids]) if len(ids) else np.zeros(0, dtype=np.int64)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte, the character that holds it
        starts = np.concatenate([[0], ends[:-1]]) if len(ids) else ends
        return np.stack([char[starts], char[ends - 1] + 1], axis=1) if len(ids) else np.zeros((0, 2), dtype=np.int64)


def _run(docs: DataFrame, json_path: str, pattern: str, key: str, text: str, schema: T.StructType, row) -> DataFrame:
    plain = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    full = T.StructType([T.StructField("k", plain.schema["k"].dataType), *schema.fields])
    arrow = to_arrow_schema(full)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(json_path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):  # bounds the pre-tokens held at once
                batch = whole.slice(at, 512)
                raw = [x or b"" for x in utf8(batch.column("t"))]
                texts = [decoded(x) for x in raw]
                rows = [row(bpe, t, ids) for t, ids in zip(texts, bpe.ids_bytes(texts))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").cast(arrow.field(0).type)]
                    + [pa.array(c, type=f.type) for c, f in zip(zip(*rows), list(arrow)[1:])],
                    schema=arrow,
                )

    return plain.mapInArrow(run, full).withColumnRenamed("k", key)


def encode(docs: DataFrame, json_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ids, and each id's ``[start, end)`` in code points of the text."""
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("starts", T.ArrayType(T.IntegerType())),
            T.StructField("ends", T.ArrayType(T.IntegerType())),
        ]
    )

    def row(bpe, t, raw):
        ids = np.frombuffer(raw, dtype="<u4")
        spans = bpe.offsets(t, ids)
        return ids.astype(np.int32), spans[:, 0].astype(np.int32), spans[:, 1].astype(np.int32)

    return _run(docs, json_path, pattern, key, text, schema, row)


def decode(encoded: DataFrame, json_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """``key`` and the text of its ids; bytes that are no UTF-8 become U+FFFD. Null ids: null text."""
    plain = encoded.select(F.col(f"`{key}`").alias("k"), "ids")
    schema = T.StructType([T.StructField("k", plain.schema["k"].dataType), T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        bpe = ByteBpe(json_path, pattern)
        for b in batches:
            texts = [None if x is None else decoded(bpe.decode(x)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("k").cast(arrow.field(0).type), pa.array(texts, type=arrow.field(1).type)], schema=arrow)

    return plain.mapInArrow(run, schema).withColumnRenamed("k", key)


def digests(docs: DataFrame, json_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Number and SHA-256 of each text's ids, and SHA-256 of the bytes decoded from them; the ids too if asked for."""
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    ids_field = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []

    def row(bpe, _t, raw):
        ids = np.frombuffer(raw, dtype="<i4")
        back = bpe.decode(ids.tolist())
        found = len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest()
        return (*found, ids) if with_ids else found

    return _run(docs, json_path, pattern, key, text, T.StructType(fields + ids_field), row)

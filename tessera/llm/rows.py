"""Row-wise operators over Arrow batches, shared by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of a-z, 0-9 and above 0x7F are word bytes; A-Z become lower case; all others a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def alnum_words(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of an A-Z lower-cased text.

    All excluded characters are ASCII, so the split can be done on UTF-8 bytes.
    """
    return text.translate(_WORD_BYTES).split() if text else []


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The values of a string column as bytes, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def decoded(text: bytes) -> str:
    """The text; bytes that are no UTF-8, which Parquet may hold, become U+FFFD."""
    return text.decode("utf-8", "replace")


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns named by place, so that no name of ours can clash, and the new name of each."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[bytes | None], tuple]],
    fields: list[tuple[str, T.DataType]],
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """``keys`` and what a function of the text returns, one row for each row.

    ``make`` runs once for each task and returns the function, so a task
    builds its automata and caches itself; nothing is kept between tasks and
    a lost executor costs only its own tasks.
    """
    names = [f"k{i}" for i in range(len(keys))]
    plain = docs.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{text}`").alias("t"))
    schema = T.StructType([T.StructField(n, plain.schema[n].dataType) for n in names] + [T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        width = len(fields)
        for batch in batches:
            texts = utf8(batch.column("t"))
            if not texts:
                continue
            columns = list(zip(*map(one, texts))) if width > 1 else [[one(x)[0] for x in texts]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).cast(arrow.field(n).type) for n in names]
                + [pa.array(c, type=arrow.field(n).type) for c, (n, _) in zip(columns, fields)],
                schema=arrow,
            )

    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], *[F.col(n) for n, _ in fields])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""New source rows against a static corpus, batch by batch as they arrive.

Each micro-batch is the batch retrieval over its rows: corpus weights, which
depend on the corpus alone but need its vocabulary for the batch's own words,
are computed in it. A batch writes to a folder of its own number, which a
replay overwrites, so no batch is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import retrieve


def match_stream(stream: DataFrame, corpus: DataFrame, ident: str, text: str, k: int, out: str, checkpoint: str, max_df: float | None = None) -> StreamingQuery:
    """Top-k TF-IDF candidates of every arriving row, in the Parquet folder ``out``, partitioned by batch."""

    def one(batch: DataFrame, number: int) -> None:
        found = retrieve.tfidf(batch, corpus, ident, retrieve.words(F.col(text)), k, max_df=max_df, content=F.col(text))
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""New queries as they arrive: each is ranked once and appended. The catalog index is static."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from matchloom.functions.text import normalise
from matchloom.operators.rerank import pending
from matchloom.operators.sparse import SparseIndex
from matchloom.operators.storage import discard, written


def match_stream(queries: DataFrame, index: SparseIndex, out: str, checkpoint: str, k: int = 5,
                 answered: str | None = None) -> StreamingQuery:
    """``queries``: a stream of query_id, text. Each query is ranked once, however often and in however many micro-batches it
    arrives: the ids that were ranked are keyed state, which the checkpoint keeps across restarts, so no batch reads an earlier answer.
    ``answered`` names a table of queries answered before the stream began; only its first batch looks there.

    Each micro-batch writes its own folder, so a replay after a failure replaces that folder and nothing is ranked twice. A batch
    reads the index, not the catalog, and leaves nothing persisted behind.
    """
    index.copies_of(k)

    def each(batch: DataFrame, number: int) -> None:
        fresh, path = written(batch, "stream-batch")           # the state is read and written once, whatever the search reads
        if answered is not None and number == 0:
            fresh = pending(fresh, batch.sparkSession.read.parquet(answered))
        mark = len(index.kept)
        ranked = index.search(fresh.select("query_id", normalise(F.col("text")).alias("norm")), k, pad=True)
        ranked.write.mode("overwrite").parquet(f"{out}/batch={number}")
        index.release(mark)
        discard(batch.sparkSession, path)

    return (queries.dropDuplicates(["query_id"]).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

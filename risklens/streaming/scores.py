"""Trigger scores of a stream of entity rows.

Thresholds are fixed when the stream starts, so flags and scores of a row depend on that row alone: no
state, no shuffle, and the same columns as in a batch. ``write_batches`` puts each micro-batch into a
folder of its own that is overwritten when the batch is repeated, so a restarted stream neither loses
nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from risklens.operators import triggers as TR


def scored_stream(rows: DataFrame, triggers: list[TR.Trigger], found: list[dict], *, key: str, target: str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Rows with flags, trigger counts, score and names, as they arrive."""
    if not rows.isStreaming:
        raise ValueError("rows must be a stream; for tables use triggers.score")
    flags = TR.flags(rows, triggers, found, key=key, target=target, keep=list(keep))
    return TR.score(flags, triggers, found)


def write_batches(scored: DataFrame, path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Start a query that writes each micro-batch to ``path/batch=<id>``; the caller waits for it.

    ``available_now`` ends it when all rows that are there have been written.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def alerts(scored: DataFrame, least: float, *, key: str) -> DataFrame:
    """Key, score and trigger names of the rows that score ``least`` or more."""
    return scored.where(F.col("score") >= least).select(key, "score", "n_hits", "hit_names")

"""Queries that read a table as a stream."""

from __future__ import annotations

from risklens.plans.catalog import query
from risklens.plans.q_actions import TRIGGERS, TSQL, found, trigger_input
from risklens.plans.workspace import Workspace
from risklens.streaming import scores as ST


@query("n1_streaming_scores", TSQL + "SELECT c_custkey, is_bad, n_hits, score, hit_names FROM sc")
def streaming_scores(ws: Workspace):
    """All entities, a few files for each micro-batch, scored as they arrive and read back."""
    source = ws.path("entities")
    trigger_input(ws).write.parquet(source)
    rows = ws.spark.readStream.schema(ws.spark.read.parquet(source).schema).option("maxFilesPerTrigger", 3).parquet(source)
    out = ws.path("scores")
    scored = ST.scored_stream(rows, TRIGGERS, found(ws), key="c_custkey", target="is_bad")
    query_ = ST.write_batches(scored, out, ws.path("progress"))
    query_.awaitTermination()
    return ws.spark.read.parquet(out).select("c_custkey", "is_bad", "n_hits", "score", "hit_names")

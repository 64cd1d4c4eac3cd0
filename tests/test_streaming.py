"""Streamed scores equal those of a batch, also after a restart."""

import tempfile

import pytest

from risklens.operators import triggers as TR
from risklens.streaming import scores as ST

TRIGGERS = [TR.Trigger("high a", "a", "positive", 0.4, "x", explicit=(">=", 5.0)), TR.Trigger("low b", "b", "negative", 0.2, "y-z"),
            TR.Trigger("none", "nope", "positive", 0.1, "y")]


def rows(lo, hi):
    return [(i, i % 5 == 0 and 1 or 0, float(i % 9), None if i % 7 == 0 else float(i % 4)) for i in range(lo, hi)]


def test_stream_equals_batch_over_restarts(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    schema = "id long, y int, a double, b double"
    spark.createDataFrame(rows(0, 120), schema).repartition(4).write.parquet(f"{folder}/in")
    found = TR.thresholds(spark.read.parquet(f"{folder}/in"), TRIGGERS, "y")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        scored = ST.scored_stream(stream, TRIGGERS, found, key="id", target="y")
        ST.write_batches(scored, f"{folder}/out", f"{folder}/progress").awaitTermination()

    run()
    spark.createDataFrame(rows(120, 150), schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run()  # goes on where it ended
    run()  # nothing new
    batch = TR.score(TR.flags(spark.read.parquet(f"{folder}/in"), TRIGGERS, found, key="id", target="y"), TRIGGERS, found)
    got = spark.read.parquet(f"{folder}/out").select(batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 150
    assert ST.alerts(got, 50.0, key="id").count() == batch.where("score >= 50").count()


def test_tables_are_refused(spark):
    with pytest.raises(ValueError):
        ST.scored_stream(spark.createDataFrame(rows(0, 3), "id long, y int, a double, b double"), TRIGGERS, [], key="id", target="y")

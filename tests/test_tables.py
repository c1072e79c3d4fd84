"""Tables that batches change, and runs of stages: what repeated, killed and changed work leaves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from evigraph.plans import stages
from evigraph.queries import event_edges, event_nodes
from evigraph.sources import shared
from evigraph.streaming import tables

from .conftest import SF

SCHEMA = "k long, seq long, v string, tags array<string>"


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    table = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=16)
    assert table.read() is None
    first = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("seq"), F.concat(F.lit("a"), F.col("id").cast("string")).alias("v"), F.array().cast("array<string>").alias("tags"))
    assert table.upsert(first, 0) == 16
    change = spark.createDataFrame([(7, 1, "b", ["x"]), (7, 2, None, ["y"]), (2000, 1, "new", None)], SCHEMA)
    assert table.upsert(change, 1) <= 2
    written = [n for n in shared.names(spark, f"file://{tmp_path}/t/data/version=1") if n.startswith("_bucket=")]
    assert 1 <= len(written) <= 2
    rows = {r.k: r for r in table.read().collect()}
    assert len(rows) == 1001 and (rows[7].seq, rows[7].v, rows[7].tags) == (2, "b", ["x", "y"]) and rows[8].v == "a8" and rows[2000].v == "new"
    # A batch that comes again changes nothing, and one that was killed before its commit is written anew.
    assert table.upsert(first, 1) == 0
    killed = spark.createDataFrame([(8, 9, "half", None)], SCHEMA)
    killed.withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"file://{tmp_path}/t/data/version=2")
    assert {r.k: r.v for r in table.read().collect()}[8] == "a8"
    assert table.upsert(spark.createDataFrame([(9, 1, "c", None)], SCHEMA), 2) == 1
    assert {r.v for r in table.read().filter("k in (8, 9)").collect()} == {"a8", "c"}
    table.vacuum()
    assert table.read().count() == 1001
    with pytest.raises(ValueError):
        table.upsert(change, -1)
    assert tables.KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=3).buckets == 16


def test_upsert_of_nulls_and_nothing(spark, tmp_path):
    table = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=4)
    assert table.upsert(spark.createDataFrame([], SCHEMA), 0) == 0 and table.read() is None
    table.upsert(spark.createDataFrame([(None, 1, "a", None), (1, None, "b", None)], SCHEMA), 1)
    table.upsert(spark.createDataFrame([(None, 2, "", None)], SCHEMA), 2)
    assert sorted(table.read().select("k", "seq", "v").collect(), key=str) == [(1, None, None), (None, 2, "a")]


def test_graph_stream_equals_the_batch_job(spark, tmp_path):
    """Over several batches, the second of which is killed between its tables, and with a batch that comes again."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartitionByRange(5, "event_id").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    calls = []

    def edges(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return event_edges(batch)

    def start():
        query = tables.graph_each_batch(stream, event_nodes, edges, f"file://{tmp_path}/graph", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="killed"):
        start()
    start()
    log = tables.BatchLog(spark, f"file://{tmp_path}/graph")
    assert len(log.commits.numbers()) == 5
    assert not log.append(4, {"nodes": event_nodes(events)})
    for name, make in (("nodes", event_nodes), ("edges", event_edges)):
        expected = make(events).drop("seq").distinct()
        found = log.read(name).select(*expected.columns)
        assert found.count() == expected.count() and found.exceptAll(expected).count() == 0


def test_runs_resume(spark, tmp_path):
    folder, made = f"file://{tmp_path}/run", []

    def stage(name, fail=False):
        def make(*inputs):
            made.append(name)
            if fail:
                inputs[0].write.parquet(f"{folder}/tables/{name}")
                raise RuntimeError("killed")
            return inputs[0].withColumn("v", F.col("v") + 1)

        return make

    rows = spark.range(10).select("id", F.col("id").alias("v"))
    run = stages.Run(spark, folder)
    run.stage("a", stage("a"), ["id"], {"rows": rows})
    with pytest.raises(RuntimeError):
        run.stage("b", stage("b", fail=True), ["id"], after=["a"])
    assert run.marker("b")["status"] == "failed"
    with pytest.raises(FileExistsError):
        stages.Run(spark, folder)
    run = stages.Run(spark, folder, stages.RESUME)
    run.stage("a", stage("a"), ["id"], {"rows": rows})
    b = run.stage("b", stage("b"), ["id"], after=["a"])
    assert made == ["a", "b", "b"] and sorted(r.v for r in b.collect()) == list(range(2, 12))
    whole = run.dataset_id()
    again = stages.Run(spark, folder, stages.RESUME)
    again.stage("a", stage("a"), ["id"], {"rows": rows.repartition(3)})
    again.stage("b", stage("b"), ["id"], after=["a"])
    assert made == ["a", "b", "b"] and again.dataset_id() == whole and again.lineage().count() == 2
    # Another input, or other parameters, make the stage and those after it anew.
    other = stages.Run(spark, folder, stages.RESUME)
    other.stage("a", stage("a"), ["id"], {"rows": rows.withColumn("v", F.lit(0).cast("long"))})
    other.stage("b", stage("b"), ["id"], after=["a"], params={"x": 1})
    assert made[3:] == ["a", "b"] and other.dataset_id() != whole
    assert stages.Run(spark, folder, stages.OVERWRITE).marker("a") is None

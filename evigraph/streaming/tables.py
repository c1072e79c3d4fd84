"""Tables that batches change: keyed tables by copy-on-write of buckets, and append logs with a ledger of batches.

Both keep one small file for each batch that is in (``commits/<number>.json``), written last and renamed into place. What has no such
file does not exist for readers, so a batch that was killed leaves nothing behind, and a batch that comes again changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import first_by, merged
from ..sources.shared import exists, get_text, names, put_text, removed


class Commits:
    """The batches that are in a table, by number."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/commits"

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in names(self.spark, self.path) if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        return json.loads(get_text(self.spark, f"{self.path}/{number}.json"))

    def put(self, number: int, facts: dict) -> None:
        put_text(self.spark, f"{self.path}/{number}.json", json.dumps(facts, sort_keys=True))


class KeyedTable:
    """A Parquet table with one row a key, in ``buckets`` of keys. A batch rewrites only the buckets that its keys fall into; a commit
    names the version of each bucket, and a reader takes the last commit's."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], seq: str, buckets: int = 64):
        self.spark, self.path, self.keys, self.seq, self.commits = spark, path.rstrip("/"), keys, seq, Commits(spark, path.rstrip("/"))
        about = f"{self.path}/table.json"
        if exists(spark, about):
            known = json.loads(get_text(spark, about))
            if known["keys"] != keys:
                raise ValueError(f"the table's keys are {known['keys']}")
            buckets = known["buckets"]
        else:
            put_text(spark, about, json.dumps({"keys": keys, "buckets": buckets}))
        self.buckets = buckets

    def _state(self, before: int | None = None) -> dict[str, int]:
        numbers = [n for n in self.commits.numbers() if before is None or n < before]
        return self.commits.read(numbers[-1])["buckets"] if numbers else {}

    def _rows(self, state: dict[str, int]) -> DataFrame | None:
        paths = [f"{self.path}/data/version={v}/_bucket={b}" for b, v in sorted(state.items())]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        """The table's rows; None before the first batch with rows."""
        return self._rows(self._state())

    def upsert(self, batch: DataFrame, number: int) -> int:
        """Merge a batch (of each column the last value by ``seq`` that is not empty) as batch ``number``; gives how many buckets it rewrote. A
        number that is in already changes nothing."""
        if number in self.commits.numbers():
            return 0
        if self.commits.numbers() and number < self.commits.numbers()[-1]:
            raise ValueError("a later batch is in already")
        bucket = F.pmod(F.xxhash64(*(F.col(k) for k in self.keys)), F.lit(self.buckets)).cast("int")
        touched = [r["_bucket"] for r in batch.select(bucket.alias("_bucket")).distinct().collect()]
        state = self._state(number)
        old = self._rows({b: v for b, v in state.items() if int(b) in touched})
        both = batch if old is None else old.unionByName(batch, allowMissingColumns=True)
        latest = both.groupBy(*self.keys).agg(F.max(self.seq).alias("_seq"))
        same = None
        for k in self.keys:
            one = F.col(k).eqNullSafe(F.col(f"_{k}"))
            same = one if same is None else same & one
        rows = merged(both, self.keys, self.seq).join(latest.withColumnsRenamed({k: f"_{k}" for k in self.keys}), same).drop(*(f"_{k}" for k in self.keys)).withColumnRenamed("_seq", self.seq)
        rows.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/data/version={number}")
        self.commits.put(number, {"buckets": state | {str(b): number for b in touched}})
        return len(touched)

    def vacuum(self) -> None:
        """Delete versions of buckets that the last commit does not name; readers of earlier commits must be done."""
        state = self._state()
        live = {(b, str(v)) for b, v in state.items()}
        for version in names(self.spark, f"{self.path}/data"):
            folder, number = f"{self.path}/data/{version}", version.removeprefix("version=")
            buckets = [n for n in names(self.spark, folder) if n.startswith("_bucket=")]
            for name in buckets:
                if (name.removeprefix("_bucket="), number) not in live:
                    removed(self.spark, f"{folder}/{name}")
            if not any(v == number for _, v in live):
                removed(self.spark, folder)


class BatchLog:
    """Several tables that batches append to together: a batch is in all of them or in none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.commits = spark, path.rstrip("/"), Commits(spark, path.rstrip("/"))

    def read(self, table: str) -> DataFrame | None:
        """The rows of a table over all batches that are in; None before the first."""
        paths = [f"{self.path}/{table}/batch={n}" for n in self.commits.numbers() if table in self.commits.read(n)["tables"]]
        return self.spark.read.parquet(*paths) if paths else None

    def append(self, number: int, tables: dict[str, DataFrame]) -> bool:
        """Write a batch's rows; what an earlier attempt left is replaced. False if the batch is in already."""
        if number in self.commits.numbers():
            return False
        for table, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={number}")
        self.commits.put(number, {"tables": sorted(tables)})
        return True


def unseen(rows: DataFrame, keys: list[str], seq: str, known: DataFrame | None) -> DataFrame:
    """The first row by ``seq`` of each key that ``known`` lacks."""
    first = first_by(rows, keys, seq)
    return first if known is None else first.join(known.select(*keys), keys, "left_anti")


def graph_each_batch(rows: DataFrame, nodes: Callable[[DataFrame], DataFrame], edges: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Extract, graph, append as a stream: ``nodes`` and ``edges`` are functions from a batch of rows to node rows (label, node_ref, ..., seq)
    and edge rows (type, start_ref, end_ref, seq). Each node and each edge is appended once, when it is first seen; both tables and
    the ledger belong together, so a killed or repeated batch leaves what one run would."""

    def put(batch: DataFrame, number: int) -> None:
        log = BatchLog(batch.sparkSession, path)
        if number in log.commits.numbers():
            return
        batch.persist()
        try:
            log.append(number, {
                "nodes": unseen(nodes(batch), ["label", "node_ref"], "seq", log.read("nodes")),
                "edges": unseen(edges(batch), ["type", "start_ref", "end_ref"], "seq", log.read("edges")),
            })
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)

"""The append log as a stream: first occurrences, keyed state, running caps."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import KeyedTable


def log_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    """Rows of a folder of Parquet files as they are added, at most ``files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def first_occurrences(rows: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows whose keys were not seen before; with an event time, state is dropped once it is ``delay`` old."""
    if event_time is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(rows: DataFrame, event_time: str, key: str, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Rows of each key by event-time window; late rows beyond ``delay`` are left out."""
    return rows.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def capped_stream(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The first ``n`` rows of each key over the whole stream, in order of ``value`` within a batch; the state is one counter a key.

    A key's rows of a batch may come in several frames, so the least of all of them are kept before any is given out."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def keep(group, frames: Iterator, state: GroupState):
        import pandas as pd

        (seen,) = state.get if state.exists else (0,)
        best = None
        for frame in frames:
            rows = frame if best is None else pd.concat([best, frame])
            best = rows.sort_values(value).head(max(0, n - seen))
        state.update((seen + (0 if best is None else len(best)),))
        if best is not None and len(best):
            yield pd.DataFrame({key: best[key], value: best[value]})

    kinds = dict(rows.dtypes)
    return rows.groupBy(key).applyInPandasWithState(keep, f"{key} {kinds[key]}, {value} {kinds[value]}", "seen long", "append", GroupStateTimeout.NoTimeout)


def upsert_each_batch(rows: DataFrame, keys: list[str], seq: str, table: str, checkpoint: str, buckets: int = 64):
    """Merge each batch into a keyed table (``tables.KeyedTable``), of which it rewrites the buckets of its keys. A batch that comes again changes
    nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        KeyedTable(batch.sparkSession, table, keys, seq, buckets).upsert(batch, number)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)

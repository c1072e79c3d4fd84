"""Where intermediate tables are written when a plan has to be cut."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in ``spark.checkpoint.dir``, deleted when the driver ends; only a local session without
    that setting gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="evigraph-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/evigraph-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    # Later tables may be read for as long as the session lives.
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier write has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def transient_shuffles(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark drops the files of shuffles as each write or collect ends; the session's setting is put back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str, rows_together: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors, and needs its shuffles no
    longer. Of large rows, ``rows_together`` are the most that a reader or writer holds."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if rows_together:
        writer = writer.option("parquet.block.row.count.limit", rows_together)
    with transient_shuffles(spark):
        writer.parquet(path)
    for made in _watching:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_watching: list[list[str]] = []


@contextlib.contextmanager
def watched() -> Iterator[list[str]]:
    """The paths of the tables that are written meanwhile, in order."""
    made: list[str] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching.pop()


def deleted(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def dropped(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    deleted(df.sparkSession, sorted({path.rsplit("/", 1)[0] for path in df.inputFiles()}))


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Meanwhile Arrow batches have at most ``most`` rows; the session's setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, "10000")
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batch, text: str, most: int):
    """Parts of an Arrow batch, each holding about ``most`` bytes of column ``text`` or one row."""
    import numpy as np

    column = batch.column(batch.schema.get_field_index(text))
    if not len(column):
        return
    size = np.diff(np.frombuffer(column.buffers()[1], dtype=np.int32 if str(column.type) in ("string", "binary") else np.int64)[column.offset : column.offset + len(column) + 1])
    block = (np.cumsum(size, dtype=np.int64) - size) // most
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(column)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)

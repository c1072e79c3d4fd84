"""Intermediate tables that all executors can read, and small files beside tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in ``spark.checkpoint.dir``, deleted when the driver ends; a local session without that
    setting gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="evigraph-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/evigraph-core-{spark.sparkContext.applicationId}"
    system, place = file_system(spark, folder)
    system.deleteOnExit(place)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: what is nondeterministic in it is fixed, lineage is cut, lost executors lose nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = file_system(spark, path)
    return system.exists(place)


def removed(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if it does not exist."""
    system, place = file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and renamed, so that it is there whole or not at all."""
    system, place = file_system(spark, path)
    _, part = file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = system.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(place, False)
    if not system.rename(part, place):
        raise OSError(f"could not write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    system, place = file_system(spark, path)
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()

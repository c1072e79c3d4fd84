"""Columns computed from Arrow batches of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .storage import slices


#: Rows of an Arrow batch, so that few texts are on their way to and from Python at a time.
BATCH_ROWS = 1_000
#: Bytes of text computed on at a time.
SLICE = 1 << 19


def quoted(name: str) -> str:
    """A column's name as one name, also with dots in it."""
    return "`" + name.replace("`", "``") + "`"


def plain_names(df: DataFrame, names: list[str], more: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """``df``'s columns ``names`` and ``more``, and what those of ``names`` are called in it: a name with dots, which mapInArrow doesn't
    take, is another."""
    called = {c: f"own_named_{k}" if set(c) & set(".`") else c for k, c in enumerate(names)}
    chosen = dict.fromkeys([*names, *more])
    return df.select(*(F.col(quoted(c)).alias(called.get(c, c)) for c in chosen)), [called[c] for c in names]


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, after its session's Arrow batches were limited to BATCH_ROWS rows (the session's setting stays so)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def with_computed(docs: DataFrame, fields: list[StructField], make: Callable[[], Callable], keep: list[str] | None = None, text: str = "text", read: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with more columns; a column of ``docs`` named like one of them goes.

    Batches have the columns that are kept, ``text`` and ``read``. ``make()`` runs once in each task and gives a function from a record batch to the Arrow arrays of
    ``fields``. Batches hold about half a MB of ``text``, or one row.
    """
    new = {field.name for field in fields}
    kept_names = [name for name in (docs.columns if keep is None else keep) if name not in new]
    source, names = plain_names(bounded_batches(docs), kept_names, [text, *(read or [])])
    schema = StructType([*(source.schema[name] for name in names), *fields])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        compute = make()
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                kept = [batch.column(batch.schema.get_field_index(name)) for name in names]
                yield pa.RecordBatch.from_arrays([*kept, *compute(batch)], names=[*names, *(field.name for field in fields)])

    return source.mapInArrow(releasing(run), schema).toDF(*kept_names, *(field.name for field in fields))


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a task, after which freed memory is given back. What ``run`` itself holds (models, tables, batches) is free only
    when it has ended, so it can't do that at its own end."""

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa

        yield from run(batches)
        released(pa)

    return whole


def released(pa) -> None:
    """Give freed memory back at the end of a task, as the Python worker lives on."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def column(batch, name: str):
    return batch.column(batch.schema.get_field_index(name))

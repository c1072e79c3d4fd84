"""Writers: logs by kind, mirrors as CSV, bulk graph files, triples, keyed tables, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, ShortType, StringType, StructType

from ..operators.graph import merged

#: Policies towards what is there already.
MODES = {"refuse": "errorifexists", "overwrite": "overwrite", "resume": "append"}


def append_log(df: DataFrame, path: str, by: str) -> None:
    """Append rows as JSON lines, one folder for each value of ``by``."""
    df.write.mode("append").partitionBy(by).json(path)


def flat_cell(c: Column, kind: DataType) -> Column:
    """A value as one line of text: lists joined by `` | ``, nested values as JSON, line ends as spaces."""
    if isinstance(kind, ArrayType) and not isinstance(kind.elementType, (ArrayType, MapType, StructType)):
        text = F.array_join(F.transform(c, lambda x: x.cast("string")), " | ")
    elif isinstance(kind, (ArrayType, MapType, StructType)):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.trim(F.regexp_replace(text, r"[\r\n]+", " "))


def flattened(df: DataFrame, first: list[str] = ()) -> DataFrame:
    """All columns as text, structs as ``outer_inner`` columns, ``first`` before the others in order of name."""

    def leaves(schema: StructType, prefix: str = "", path: str = ""):
        for field in schema.fields:
            where = f"{path}.`{field.name}`" if path else f"`{field.name}`"
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, f"{prefix}{field.name}_", where)
            else:
                yield f"{prefix}{field.name}", flat_cell(F.col(where), field.dataType)

    cells = dict(leaves(df.schema))
    order = [c for c in first if c in cells] + sorted(c for c in cells if c not in first)
    return df.select(*(cells[c].alias(c) for c in order))


def write_csv(df: DataFrame, path: str, first: list[str] = (), mode: str = "refuse", separator: str = ",", header: bool = True) -> None:
    flattened(df, list(first)).write.mode(MODES[mode]).option("header", header).option("sep", separator).option("encoding", "UTF-8").csv(path)


def write_triples(df: DataFrame, path: str, mode: str = "refuse") -> None:
    """Three columns by tab, without a header."""
    df.write.mode(MODES[mode]).option("sep", "\t").option("header", False).csv(path)


def bulk_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes with the columns of a bulk loader; properties after them."""
    rest = sorted(c for c in nodes.columns if c not in ("node_ref", "label"))
    return nodes.select(F.col("node_ref").alias(":ID"), F.col("label").alias(":LABEL"), *rest)


def bulk_edges(edges: DataFrame) -> DataFrame:
    rest = sorted(c for c in edges.columns if c not in ("start_ref", "end_ref", "type"))
    return edges.select(F.col("start_ref").alias(":START_ID"), F.col("end_ref").alias(":END_ID"), F.col("type").alias(":TYPE"), *rest)


def sanitized(props: Column) -> Column:
    """A property map without nulls and blanks."""
    return F.map_filter(props, lambda k, v: v.isNotNull() & (F.trim(v) != ""))


def sanitized_columns(df: DataFrame) -> DataFrame:
    """Properties that any graph store takes: numbers, booleans and text as they are (dates and decimals as text), lists of these without nulls,
    and everything nested (maps, structs, lists of lists) as JSON text. Nulls stay null: a writer leaves them out."""
    plain = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, StringType)

    def safe(c: Column, kind: DataType) -> Column:
        if isinstance(kind, plain):
            return c
        if isinstance(kind, ArrayType) and not isinstance(kind.elementType, (ArrayType, MapType, StructType)):
            values = F.array_compact(c)
            return values if isinstance(kind.elementType, plain) else F.transform(values, lambda x: x.cast("string"))
        return F.to_json(c) if isinstance(kind, (ArrayType, MapType, StructType)) else c.cast("string")

    return df.select(*(safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))


def upserted(table: DataFrame, updates: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """A keyed table after updates: of each property the last value that is not empty."""
    return merged(table.unionByName(updates, allowMissingColumns=True), keys, seq)


def manifest_row(spark: SparkSession, fields: dict) -> DataFrame:
    """One row of run metadata with the hash of its content."""
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in sorted(fields.items())))
    return row.withColumn("content_sha256", F.sha2(F.to_json(F.struct(*sorted(fields))), 256))


def sanitized_file_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_"), F.lit("_"))

"""Node and edge tables: merging, deduplication, integrity, ids and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from ..sources.shared import written


def merged(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row a key: of each column the last value that is not empty, by ``seq``; lists are united in order, maps
    merged key by key with later values winning. Empty text, lists and maps never overwrite."""
    out = []
    for field in df.schema.fields:
        if field.name in (*keys, seq):
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, ArrayType):
            ordered = F.array_sort(F.collect_list(F.when(F.size(c) > 0, F.struct(F.col(seq).alias("s"), c.alias("v")))))
            out.append(F.array_distinct(F.flatten(F.transform(ordered, lambda x: x["v"]))).alias(field.name))
        elif isinstance(field.dataType, MapType):
            entries = F.transform(F.map_entries(c), lambda e: F.struct(F.col(seq).alias("s"), e["key"].alias("k"), e["value"].alias("v")))
            every = F.flatten(F.array_sort(F.collect_list(F.when(F.size(c) > 0, entries))))
            last = F.transform(
                F.array_distinct(F.transform(every, lambda e: e["k"])),
                lambda k: F.struct(k, F.try_element_at(F.filter(every, lambda e: (e["k"] == k) & e["v"].isNotNull()), F.lit(-1))["v"]),
            )
            out.append(F.map_from_entries(last).alias(field.name))
        else:
            given = c.isNotNull() & (F.trim(c) != "") if field.dataType.simpleString() == "string" else c.isNotNull()
            out.append(F.max_by(F.when(given, c), F.when(given, F.col(seq))).alias(field.name))
    return df.groupBy(*keys).agg(*out)


def entities(key: str, *layers: DataFrame, seq: str | None = None) -> DataFrame:
    """One row for each ``key`` of several tables of an entity's properties (null keys go), columns of the same name as one: of each the
    last value that is not empty, later tables after earlier ones, and within a table by ``seq`` where it has that column. The tables
    are put under each other and shuffled once."""
    out = None
    for number, rows in enumerate(layers):
        at = F.struct(F.lit(number).alias("layer"), (F.col(seq).cast("long") if seq in rows.columns else F.lit(0).cast("long")).alias("seq"))
        rows = rows.filter(F.col(key).isNotNull()).withColumn("_at", at).drop(*([seq] if seq else []))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return merged(out, [key], "_at")


def term_list(nodes: DataFrame, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """Distinct terms of nodes (label, props) in order: ``kinds`` give for a label the prefix of its terms and the property that holds the
    id, from which such a prefix is taken off first."""
    term = None
    for label, (prefix, name) in kinds.items():
        plain = F.nullif(F.trim(F.regexp_replace(F.col("props")[name], f"^{prefix}", "")), F.lit(""))
        one = F.concat(F.lit(prefix), plain)
        term = F.when(F.col("label") == label, one) if term is None else term.when(F.col("label") == label, one)
    return nodes.select("label", term.alias("term")).filter("term is not null").distinct().orderBy("label", "term")


def first_by(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The first row of each key by ``seq``."""
    rest = [c for c in df.columns if c not in (*keys, seq)]
    if not rest:
        return df.select(*keys).distinct()
    found = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), seq).alias("_row"))
    return found.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def props_fingerprint(*columns: str) -> Column:
    """A hash of properties by name, nulls left out."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def distinct_edges(edges: DataFrame, props: list[str]) -> DataFrame:
    """Edges once for each type, ends and properties; edges that differ in properties stay apart."""
    keyed = edges.withColumn("rel_id", F.sha2(F.to_json(F.struct("type", "start_ref", "end_ref", *sorted(props))), 256))
    return keyed.dropDuplicates(["rel_id"])


def checked_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with ``dangling``: an end is no node."""
    refs = nodes.select("node_ref").distinct()
    for side in ("start", "end"):
        edges = edges.join(refs.select(F.col("node_ref").alias(f"{side}_ref"), F.lit(True).alias(f"_{side}")), f"{side}_ref", "left")
    return edges.withColumn("dangling", F.col("_start").isNull() | F.col("_end").isNull()).drop("_start", "_end")


def count_report(rows: DataFrame, label: str, ref: str) -> DataFrame:
    """Raw, unique and duplicate counts of each label."""
    found = rows.groupBy(label).agg(F.count("*").alias("n_rows"), F.count_distinct(ref).alias("n_unique"))
    return found.withColumn("n_duplicates", F.col("n_rows") - F.col("n_unique"))


def dense_ids(df: DataFrame, order: list[str], name: str = "node_id") -> DataFrame:
    """Rows with ids 0 to n - 1 in the given order; rows that it does not tell apart are numbered in any order.

    Rows are range-partitioned and sorted once, and written with their place: the number of their partition above the bits of
    their row. Counts, starts and ids all come from what was written, so they belong together whatever Spark does with the
    plan; one count for each partition is summed up.
    """
    by = [*order, "_tie"]
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    rows = written(placed.withColumn("_at", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright("_at", 33)
    counts = sorted(rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.max("_at").alias("last")).collect())
    starts, total = [], 0
    for r in counts:
        if (r.last & (1 << 33) - 1) != r.n - 1:
            raise RuntimeError("a partition was not written whole")
        starts.append((r.part, total))
        total += r.n
    # One row a partition that was written.
    where = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _start long"))
    placed = rows.withColumn("_part", part).join(where, "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_start", "_at")


def local_ids(df: DataFrame, label: str, order: str, name: str = "local_id") -> DataFrame:
    """Ids 0 to n - 1 within each label, in order of a dense id: id minus the least of the label, as labels are
    contiguous in it."""
    first = df.groupBy(label).agg(F.min(order).alias("_first"))
    return df.join(first, label).withColumn(name, F.col(order) - F.col("_first")).drop("_first")


def capped(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """At most ``n`` rows of each key, the first in order. Spark limits each task's rows before the shuffle."""
    ranked = df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_k") <= n).drop("_k")


def links_by_members(links: DataFrame, group: str, member: str) -> tuple[DataFrame, DataFrame]:
    """Distinct ``links(group, member)`` of members that are in one group, and of the other members (and without one)."""
    groups = written(links.filter(F.col(group).isNotNull()).groupBy(member).agg(F.collect_set(group).alias("_groups")), "groups-of-members")
    alone = (F.size("_groups") == 1) & F.col(member).isNotNull()
    return groups.filter(alone).select(F.col("_groups")[0].alias(group), member), groups.filter(~alone).select(F.explode("_groups").alias(group), member)


def fanned_out(rows: DataFrame, links: DataFrame, group: str, member: str, left_out: str, broadcast_rows: int = 100_000, dealt: bool = False) -> DataFrame:
    """``rows`` of groups with each ``member`` of their group by distinct ``links``, but those in the array column ``left_out``.

    For few and large groups: what comes of it grows with the square of the tables, so it is neither shuffled nor written, and what it is
    made of should have its final form before. Links are broadcast after a count, in blocks of ``broadcast_rows`` at most; the number of
    partitions is one that Spark doesn't lower, as rows are few before they fan out (``dealt``: so they are already). Rows of a group follow
    each other in a task, so the same members repeat, and a file of them is a small part of what it would be otherwise."""
    if not dealt:
        rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Spark leaves out a sort below a join, unless a filter is between them that it can't move.
    rows = rows.sortWithinPartitions(group).filter(F.monotonically_increasing_id() >= 0)
    blocks = -(-links.count() // broadcast_rows) or 1
    if blocks > 1:
        rows = written(rows, "rows-of-groups")
    out = None
    for number in range(blocks):
        block = links.filter(F.pmod(F.xxhash64(member), F.lit(blocks)) == number) if blocks > 1 else links
        made = rows.join(F.broadcast(block), group).filter(~F.coalesce(F.array_contains(left_out, F.col(member)), F.lit(False))).drop(left_out)
        out = made if out is None else out.unionByName(made)
    return out


def degrees(edges: DataFrame, start: str, end: str) -> DataFrame:
    """Undirected degree of each node that has an edge."""
    ends = edges.select(F.explode(F.array(start, end)).alias("node"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def schema_counts(edges: DataFrame) -> DataFrame:
    """Edges by label of the start, type and label of the end."""
    return edges.groupBy("start_label", "type", "end_label").agg(F.count("*").alias("n"))


def schema_alignment(observed: DataFrame, expected: DataFrame, columns: list[str]) -> DataFrame:
    """What is expected but missing, and what is there but not expected."""
    seen, wanted = observed.select(*columns).distinct(), expected.select(*columns).distinct()
    return wanted.join(seen, columns, "left_anti").withColumn("status", F.lit("missing")).unionByName(seen.join(wanted, columns, "left_anti").withColumn("status", F.lit("extra")))


def missing_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a required key, and which."""
    absent = F.array_compact(F.array(*(F.when(F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == ""), k) for k in keys)))
    return df.withColumn("missing_keys", F.array_join(absent, ",")).filter("missing_keys != ''")


def reversed_edges(edges: DataFrame, keep: tuple[str, ...] = ("SIMILAR_TO",)) -> DataFrame:
    """Edges and their reverses; a reverse has ``rev_`` before its type unless the type is symmetric."""
    name = F.when(F.col("type").isin(*keep), F.col("type")).otherwise(F.concat(F.lit("rev_"), F.col("type")))
    back = edges.select(F.col("end_ref").alias("start_ref"), F.col("start_ref").alias("end_ref"), name.alias("type"))
    return edges.select("start_ref", "end_ref", "type").unionByName(back)


def layered(*layers: tuple[str, DataFrame]) -> DataFrame:
    """All layers one after another, with their name; columns that a layer lacks are null."""
    out = None
    for name, rows in layers:
        rows = rows.withColumn("layer", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out

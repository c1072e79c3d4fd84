"""The topology of a model graph as tables: node types, edge sets, types and end labels, degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def node_degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node_id, degree (both directions; an edge from a node to itself counts twice), node_ref and label of each node that has an edge; of an
    end that ``nodes(node_id, node_ref, label)`` lacks the latter are null."""
    ends = edges.select(F.explode(F.array("source_node_id", "target_node_id")).alias("node_id")).filter("node_id is not null")
    return ends.groupBy("node_id").agg(F.count("*").alias("degree")).join(nodes.select("node_id", "node_ref", "label"), "node_id", "left")


def degree_summary(degrees: DataFrame) -> DataFrame:
    """Nodes, mean, median and highest degree by label."""
    return degrees.groupBy("label").agg(F.count("*").alias("n"), F.avg("degree").alias("mean"), F.median("degree").alias("median"), F.max("degree").alias("max"))


def topology(nodes: DataFrame, edge_sets: dict[str, DataFrame]) -> DataFrame:
    """section, edge_set, name, other and n of a graph: ``node_type`` (by label), ``edge_set`` (its size, also of an empty one), ``edge_type`` and
    ``label_pair`` (name to other) of each edge set. Each edge set is aggregated once, by type and labels."""
    row = lambda df, section, edge_set, name, other, n: df.select(F.lit(section).alias("section"), F.lit(edge_set).cast("string").alias("edge_set"), name.cast("string").alias("name"), other.cast("string").alias("other"), n.cast("long").alias("n"))
    none = F.lit(None)
    out = row(nodes.groupBy("label").agg(F.count("*").alias("n")), "node_type", None, F.col("label"), none, F.col("n"))
    for name, edges in edge_sets.items():
        sets = edges.groupBy("type", "start_label", "end_label").agg(F.count("*").alias("n"))
        # A row of nothing, so that an empty set has its size too.
        empty = nodes.sparkSession.range(1).select(*(F.lit(None).cast(sets.schema[c].dataType).alias(c) for c in ("type", "start_label", "end_label")), F.lit(0).cast("long").alias("n"))
        grouped = sets.unionByName(empty).groupingSets([[], ["type"], ["start_label", "end_label"]], "type", "start_label", "end_label")
        every = grouped.agg(F.sum("n").alias("n"), F.grouping_id().alias("g")).filter("n > 0 or g = 7")
        section = F.when(F.col("g") == 7, "edge_set").when(F.col("g") == 3, "edge_type").otherwise("label_pair")
        out = out.unionByName(
            every.select(section.alias("section"), F.lit(name).alias("edge_set"), F.when(F.col("g") == 3, F.col("type")).otherwise(F.col("start_label")).cast("string").alias("name"), F.col("end_label").cast("string").alias("other"), F.col("n").cast("long").alias("n"))
        )
    return out


def top(df: DataFrame, by: str, n: int, per: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by`` (of each ``per``), nulls last, ties by the columns ``ties``."""
    order = [F.desc_nulls_last(by), *ties]
    if per is None:
        return df.orderBy(*order).limit(n)
    from .graph import capped

    return capped(df, [per], order, n)


def similarity_only(materialised: DataFrame, similar: DataFrame, asserted: DataFrame) -> DataFrame:
    """Distinct ids that are materialised and similar to something, but that no assertion names."""
    ids = lambda df: df.select("id").filter("id is not null").distinct()
    return ids(materialised).join(ids(similar), "id", "left_semi").join(ids(asserted), "id", "left_anti")

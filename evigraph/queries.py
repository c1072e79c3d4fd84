"""Registered queries over the driver tables, each with its DuckDB SQL where SQL can say it.

``@query(sql)`` registers a function of the domain tables under its name; SQL that reads domain views is given
through ``over_views``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import descriptors as D
from .functions import endpoint as E
from .functions import targets as T
from .functions import text as X
from .operators import components, evidence, extract, features, graph, mapping, quality, similarity
from .plans import stages
from .plans.domain import Tables, over_views
from .sources import readers, writers
from .streaming import jobs, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def labelled(t: Tables) -> DataFrame:
    return E.with_label(E.with_normalized_endpoint(t.endpoint), 10.0, True)


def paths(t: Tables) -> DataFrame:
    return evidence.paths_by_compound(labelled(t), t.substance, tested_rows(t))


def tested_rows(t: Tables) -> DataFrame:
    """Rows of ``tested_on`` before they are made distinct."""
    return t.lineitem.select(F.col("l_orderkey").alias("mg_id"), F.col("l_suppkey").alias("protein_id"))


def known_symbol_sql(accession: str, digits: str) -> str:
    """SQL for the P450 symbol of a known accession, or of a gene id that the same text's digits are."""
    case = lambda c, table: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"
    return f"coalesce({case(accession, T.ACCESSION_SYMBOL)}, {case(digits, T.GENE_SYMBOL)})"


# Measurements -------------------------------------------------------------------------------------------------


@query(over_views("""
SELECT endpoint_id, endpoint_type, CASE unit WHEN 'pM' THEN 'UO:0000066' WHEN 'nM' THEN 'UO:0000065' ELSE 'UO:0000064' END AS unit_curie,
       CASE qualifier WHEN '=' THEN 'eq' WHEN '<' THEN 'lt' ELSE 'gt' END AS qualifier_normalized, value_molar,
       low AS value_lower_molar, high AS value_upper_molar, CASE WHEN value > 0 THEN 'normalized_concentration' ELSE 'nonpositive_value' END AS normalization_status,
       coalesce(comparable, false) AND value > 0 AS threshold_label_eligible
FROM bounded
"""))
def n1_normalized_endpoints(t):
    found = E.with_normalized_endpoint(t.endpoint)
    return found.select("endpoint_id", "endpoint_type", "unit_curie", "qualifier_normalized", "value_molar", "value_lower_molar", "value_upper_molar", "normalization_status", "threshold_label_eligible")


UNIT_FORMS = ["UO:62", "http://purl.example.org/obo/UO_0000063", "uM", "nm", "MicroMolar", "mg/L", "  ", "pM", "M", "UO:0000065"]


@query("""
SELECT l_orderkey AS k, l_linenumber AS n, CASE l_partkey % 10 WHEN 0 THEN 'UO:0000062' WHEN 1 THEN 'UO:0000063' WHEN 2 THEN 'UO:0000064' WHEN 3 THEN 'UO:0000065'
  WHEN 4 THEN 'UO:0000064' WHEN 7 THEN 'UO:0000066' WHEN 8 THEN 'UO:0000062' WHEN 9 THEN 'UO:0000065' END AS curie FROM lineitem
""")
def n4_unit_curie(t):
    unit = F.get(F.array(*map(F.lit, UNIT_FORMS)), F.col("l_partkey") % 10)
    return t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), E.unit_curie(unit).alias("curie"))


@query("SELECT l_orderkey AS k, l_quantity * CASE l_returnflag WHEN 'A' THEN 1e-3 WHEN 'N' THEN 1e-9 ELSE NULL END AS molar FROM lineitem")
def n5_to_molar(t):
    unit = F.when(F.col("l_returnflag") == "A", "mM").when(F.col("l_returnflag") == "N", "UO:65").otherwise("mg/L")
    return t.lineitem.select(F.col("l_orderkey").alias("k"), E.to_molar(F.col("l_quantity"), unit).alias("molar"))


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' WHEN 2 THEN 'IC50' WHEN 3 THEN 'inconclusive' WHEN 4 THEN lower(replace(o_orderpriority, '-', ' ')) END AS outcome FROM orders")
def n6_outcome_label(t):
    forms = F.array(F.lit("http://x.example.org/voc#Active"), F.lit("no-activity"), F.lit("pubchem/IC_50"), F.lit("Ambiguous"), F.col("o_orderpriority"), F.lit(" "))
    return t.orders.select("o_orderkey", E.outcome_label(F.get(forms, F.col("o_orderkey") % 6)).alias("outcome"))


@query("SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'IC50' WHEN 1 THEN 'Ki' WHEN 2 THEN 'Kd' WHEN 3 THEN 'EC50' WHEN 4 THEN 'INH' WHEN 6 THEN 'Potency' WHEN 7 THEN 'AC50' END AS kind, p_partkey % 8 IN (0, 2) AS is_log FROM part")
def n7_endpoint_type(t):
    forms = F.array(*map(F.lit, ["pIC50 of x", "a K_i value", "pKd", "EC-50 (cell)", "inhibition", "kinase", "Potency", "AC 50"]))
    text = F.get(forms, F.col("p_partkey") % 8)
    return t.part.select("p_partkey", E.endpoint_type(text).alias("kind"), (E.reported_scale(text) == "negative_log10_molar").alias("is_log"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, CASE l_linenumber WHEN 1 THEN 'le' WHEN 2 THEN 'gt' WHEN 3 THEN 'approx' WHEN 4 THEN 'unknown' WHEN 5 THEN 'eq' WHEN 6 THEN 'ge' ELSE 'range' END AS q FROM lineitem")
def n9_qualifier(t):
    given = F.get(F.array(F.lit("≤"), F.lit(None), F.lit("about"), F.lit("odd"), F.lit(None), F.lit("x#greater than or equal"), F.lit("between")), F.col("l_linenumber") - 1)
    raw = F.when(F.col("l_linenumber") == 2, F.concat(F.lit(" > "), F.col("l_partkey").cast("string"))).otherwise(F.col("l_partkey").cast("string"))
    return t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), E.qualifier(given, raw).alias("q"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_partkey AS DOUBLE) AS number, CAST(least(l_partkey, l_suppkey) AS DOUBLE) AS low, CAST(greatest(l_partkey, l_suppkey) AS DOUBLE) AS high FROM lineitem")
def n11_ranges(t):
    text = F.concat(F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, " - ").otherwise(" to "), F.col("l_suppkey").cast("string"))
    span = E.parsed_range(text)
    number = E.parsed_number(F.concat(F.lit("about "), F.col("l_partkey").cast("string"), F.lit(" units")))
    return t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), number.alias("number"), span["low"].alias("low"), span["high"].alias("high"))


@query(over_views("""
SELECT endpoint_id, CAST(label AS INTEGER) AS label,
  CASE WHEN outcome = 'inconclusive' THEN 'explicit_outcome_is_ambiguous_or_conflicting'
       WHEN under AND outcome = 'inactive' THEN 'numeric_active_conflicts_with_source_inactive'
       WHEN under THEN 'complete_interval_at_or_below_threshold'
       WHEN above AND outcome = 'active' THEN 'numeric_weak_conflicts_with_source_active'
       WHEN above THEN 'complete_interval_strictly_above_threshold'
       WHEN coalesce(comparable, false) THEN 'measurement_interval_crosses_activity_threshold'
       WHEN outcome = 'inactive' THEN 'unsupported_numeric_type_but_source_declared_inactive'
       WHEN outcome = 'active' THEN 'unsupported_numeric_type_but_source_declared_active'
       ELSE 'endpoint_type_not_eligible_for_threshold_labeling' END AS label_reason
FROM labelled
"""))
def l1_label_decisions(t):
    # A declared outcome is also where a type may be named; here none does.
    return labelled(t).select("endpoint_id", "label", "label_reason")


@query(over_views("SELECT endpoint_id, CAST(CASE outcome WHEN 'inactive' THEN 0 WHEN 'active' THEN 1 END AS INTEGER) AS label FROM labelled"))
def l2_labels_without_threshold(t):
    return E.with_label(E.with_normalized_endpoint(t.endpoint), None).select("endpoint_id", "label")


# Pairs --------------------------------------------------------------------------------------------------------


@query(over_views("""
SELECT cid, protein_id, n_endpoints, n_groups, n_substances, n_positive, n_negative, n_unclear, n_references,
  CASE WHEN n_positive > 0 AND n_negative > 0 THEN 'curated_conflicting' WHEN n_positive > 0 THEN 'curated_active' WHEN n_negative > 0 THEN 'curated_inactive' ELSE 'curated_unlabeled' END AS assertion,
  CASE WHEN n_positive > 0 AND n_negative > 0 THEN greatest(n_positive, n_negative) WHEN n_positive > 0 THEN n_positive WHEN n_negative > 0 THEN n_negative ELSE n_unclear END / greatest(1, n_positive + n_negative + n_unclear) AS confidence
FROM (
  SELECT cid, protein_id, count(DISTINCT e.endpoint_id) AS n_endpoints, count(DISTINCT mg_id) AS n_groups, count(DISTINCT sid) AS n_substances,
         count(*) FILTER (WHERE label = 1) AS n_positive, count(*) FILTER (WHERE label = 0) AS n_negative, count(*) FILTER (WHERE label IS NULL) AS n_unclear, count(DISTINCT reference_id) AS n_references
  FROM evidence e JOIN supported_by r ON r.endpoint_id = e.endpoint_id GROUP BY cid, protein_id
)
"""))
def a4_interaction_support(t):
    return evidence.interaction_support_by_compound(labelled(t), t.substance, tested_rows(t), t.supported_by)


PAIR_SQL = """, pairs AS (
  SELECT cid, protein_id, count(*) AS n_endpoints, min(value_molar) AS min_value_molar, min(value_molar * 1e6) AS min_value_um,
         min(value_molar * 1e6) FILTER (WHERE endpoint_type = 'IC50') AS min_ic50_um, min(value_molar * 1e6) FILTER (WHERE endpoint_type = 'Ki') AS min_ki_um,
         min(value_molar * 1e6) FILTER (WHERE endpoint_type = 'Kd') AS min_kd_um, min(value_molar * 1e6) FILTER (WHERE endpoint_type = 'EC50') AS min_ec50_um,
         min(value_molar * 1e6) FILTER (WHERE endpoint_type = 'AC50') AS min_ac50_um,
         count(*) FILTER (WHERE endpoint_type = 'IC50') AS n_ic50, count(*) FILTER (WHERE endpoint_type = 'Ki') AS n_ki, count(*) FILTER (WHERE endpoint_type = 'Kd') AS n_kd,
         count(*) FILTER (WHERE endpoint_type = 'EC50') AS n_ec50, count(*) FILTER (WHERE endpoint_type = 'AC50') AS n_ac50,
         count(*) FILTER (WHERE label = 1) AS n_active, count(*) FILTER (WHERE label = 0) AS n_weak, count(*) FILTER (WHERE label IS NULL) AS n_unlabelled
  FROM evidence GROUP BY cid, protein_id
), featured AS (
  SELECT *, concat_ws(';', CASE WHEN n_ac50 > 0 THEN 'AC50=' || n_ac50 END, CASE WHEN n_ec50 > 0 THEN 'EC50=' || n_ec50 END, CASE WHEN n_ic50 > 0 THEN 'IC50=' || n_ic50 END,
                          CASE WHEN n_kd > 0 THEN 'Kd=' || n_kd END, CASE WHEN n_ki > 0 THEN 'Ki=' || n_ki END) AS endpoint_types,
         CAST(CASE WHEN n_active > 0 AND n_weak = 0 THEN 1 WHEN n_weak > 0 AND n_active = 0 THEN 0 END AS INTEGER) AS label
  FROM pairs
)
"""


@query(over_views(PAIR_SQL + "SELECT * FROM featured"))
def a5_pair_features(t):
    """The flagship: labelled measurements joined along all paths and aggregated to pairs."""
    return evidence.endpoint_features(paths(t)).drop("max_negative_log10_molar")


@query(over_views(PAIR_SQL + "SELECT coalesce(CAST(label AS VARCHAR), 'none') AS label, count(*) AS n, sum(n_endpoints) AS n_endpoints FROM featured GROUP BY 1"))
def l4_pair_labels(t):
    found = evidence.endpoint_features(paths(t))
    return found.groupBy(F.coalesce(F.col("label").cast("string"), F.lit("none")).alias("label")).agg(F.count("*").alias("n"), F.sum("n_endpoints").cast("decimal(38,0)").alias("n_endpoints"))


@query("""
SELECT l_partkey AS cid, l_suppkey AS protein_id, count(*) AS support,
  sum(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity ELSE 0 END) / sum(l_quantity) AS score, 'weighted_mean' AS model
FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 2
""")
def a8_weighted_scores(t):
    rows = t.lineitem.select(F.col("l_partkey").alias("cid"), F.col("l_suppkey").alias("protein_id"), (F.col("l_linenumber") % 2).alias("activity"), F.col("l_quantity").alias("w"), F.col("l_orderkey").cast("string").alias("endpoint_id"))
    return evidence.weighted_scores(rows, 2).drop("evidence")


@query("""
WITH r AS (
  SELECT l_partkey AS cid, l_suppkey AS protein_id, l_orderkey AS record_id, CASE WHEN l_linenumber = 1 THEN l_quantity END AS kd, CASE WHEN l_linenumber = 2 THEN l_quantity END AS ki,
         CASE WHEN l_linenumber > 2 THEN l_quantity END AS ic50 FROM lineitem
), s AS (SELECT cid, protein_id, count(DISTINCT record_id) AS n_records, min(kd) AS min_kd, min(ki) AS min_ki, min(ic50) AS min_ic50 FROM r GROUP BY 1, 2)
SELECT *, least(min_kd, min_ki, min_ic50) AS best_value,
  CASE WHEN min_kd = least(min_kd, min_ki, min_ic50) THEN 'Kd' WHEN min_ki = least(min_kd, min_ki, min_ic50) THEN 'Ki' ELSE 'IC50' END AS best_type FROM s
""")
def a7_binding_features(t):
    value = lambda cond: F.when(cond, F.col("l_quantity"))
    line = F.col("l_linenumber")
    rows = t.lineitem.select(F.col("l_partkey").alias("cid"), F.col("l_suppkey").alias("protein_id"), F.col("l_orderkey").alias("record_id"), value(line == 1).alias("kd"), value(line == 2).alias("ki"), value(line > 2).alias("ic50"))
    return evidence.binding_features(rows)


@query("""
WITH m AS (SELECT l_partkey AS cid, l_suppkey AS protein_id, l_orderkey AS mention_id, l_orderkey % 1000 AS reference_id, CASE WHEN l_linenumber > 1 THEN 0.5 ELSE 0.25 END AS score FROM lineitem),
f AS (SELECT cid, protein_id, count(DISTINCT mention_id) AS n_mentions, count(DISTINCT reference_id) AS n_references, max(score) AS max_score, avg(score) AS mean_score FROM m GROUP BY 1, 2),
g AS (SELECT *, round(least(1.0, max_score + 0.03 * least(n_mentions, 10) + 0.02 * least(n_references, 10)), 6) AS confidence FROM f)
SELECT cid, protein_id, n_mentions, n_references, CAST(max_score AS DOUBLE) AS max_score, CAST(mean_score AS DOUBLE) AS mean_score, CAST(confidence AS DOUBLE) AS confidence,
  CASE WHEN confidence >= 0.75 THEN 'high' WHEN confidence >= 0.45 THEN 'medium' ELSE 'low' END AS confidence_band FROM g
""")
def a6_comention_features(t):
    score = F.when(F.col("l_linenumber") > 1, F.lit(0.5))
    rows = t.lineitem.select(F.col("l_partkey").alias("cid"), F.col("l_suppkey").alias("protein_id"), F.col("l_orderkey").alias("mention_id"), (F.col("l_orderkey") % 1000).alias("reference_id"), score.alias("score"))
    return evidence.comention_features(rows).withColumn("confidence", F.round("confidence", 6))


@query(over_views("SELECT mg_id, max(sid) AS sid FROM (SELECT mg_id, sid, endpoint_id, row_number() OVER (PARTITION BY mg_id ORDER BY endpoint_id DESC) AS k FROM endpoint) WHERE k = 1 GROUP BY mg_id"))
def j25_last_substance(t):
    return evidence.last_by(t.endpoint.select("mg_id", "sid", "endpoint_id"), "mg_id", "sid", "endpoint_id")


@query(over_views("SELECT DISTINCT m.aid AS \"start\", r.reference_id AS \"end\" FROM measuregroup m JOIN endpoint e USING (mg_id) JOIN supported_by r USING (endpoint_id)"))
def j19_described_by(t):
    return evidence.path_edges((t.measuregroup, "aid", "mg_id"), (t.endpoint, "mg_id", "endpoint_id"), (t.supported_by, "endpoint_id", "reference_id"))


@query(over_views("SELECT DISTINCT m.aid AS \"start\", s.cid AS \"end\" FROM measuregroup m JOIN endpoint e USING (mg_id) JOIN substance s USING (sid)"))
def j20_has_source(t):
    return evidence.path_edges((t.measuregroup, "aid", "mg_id"), (t.endpoint, "mg_id", "sid"), (t.substance, "sid", "cid"))


@query(over_views("SELECT DISTINCT t.mg_id, coalesce(CASE WHEN p.taxid % 3 = 0 THEN p.taxid END, 9606) AS taxid FROM tested_on t JOIN protein p USING (protein_id)"))
def j21_inferred_organism(t):
    known = t.protein.withColumn("taxid", F.when(F.col("taxid") % 3 == 0, F.col("taxid")))
    return t.tested_on.join(known, "protein_id").select("mg_id", F.coalesce("taxid", F.lit(9606)).alias("taxid")).distinct()


@query(over_views("SELECT e.endpoint_id, count(DISTINCT e.mg_id) AS n_groups, count(DISTINCT m.aid) AS n_assays, count(DISTINCT r.reference_id) AS n_references FROM endpoint e LEFT JOIN measuregroup m USING (mg_id) LEFT JOIN supported_by r ON r.endpoint_id = e.endpoint_id GROUP BY 1"))
def a11_endpoint_context(t):
    return evidence.endpoint_context(t.endpoint, t.measuregroup, t.supported_by)


@query(over_views("SELECT cid, protein_id FROM compound, protein WHERE (cid, protein_id) NOT IN (SELECT cid, protein_id FROM evidence)"))
def j35_candidate_pairs(t):
    return evidence.candidate_pairs(t.compound, t.protein, paths(t))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY sha1('13|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey) LIMIT 1000")
def ow11_seeded_sample(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return evidence.sampled(t.lineitem.select(*keys), keys, 1000)


# Graph tables -------------------------------------------------------------------------------------------------


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) FILTER (WHERE event_id % 3 <> 0) AS value FROM events GROUP BY user_id")
def a1_last_non_empty(t):
    value = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return graph.merged(t.events.select("user_id", "event_id", "event_type", value.alias("value")), ["user_id"], "event_id")


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_min(ts, event_id) AS ts FROM events GROUP BY user_id")
def a2_first_occurrence(t):
    return graph.first_by(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], "event_id")


@query("SELECT DISTINCT 'TESTED_ON' AS type, 'MeasureGrp|mg_id=' || l_orderkey AS start_ref, 'Protein|protein_id=' || l_suppkey AS end_ref FROM lineitem")
def a3_distinct_edges(t):
    return graph.distinct_edges(tested_edges(t), []).drop("rel_id")


def tested_edges(t: Tables) -> DataFrame:
    return t.lineitem.select(F.lit("TESTED_ON").alias("type"), X.node_ref("MeasureGrp", mg_id="l_orderkey").alias("start_ref"), X.node_ref("Protein", protein_id="l_suppkey").alias("end_ref"))


@query("SELECT (p_partkey % 50 = 7) AS dangling, count(*) AS n FROM part GROUP BY 1")
def j32_dangling_edges(t):
    nodes = t.part.select(X.node_ref("Compound", cid="p_partkey").alias("node_ref"))
    other = F.when(F.col("p_partkey") % 50 == 7, -F.col("p_partkey")).otherwise(F.col("p_partkey"))
    edges = t.part.select(X.node_ref("Compound", cid="p_partkey").alias("start_ref"), X.node_ref("Compound", cid=other).alias("end_ref"))
    return graph.checked_edges(edges, nodes).groupBy("dangling").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag AS label, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_unique, count(*) - count(DISTINCT l_partkey) AS n_duplicates FROM lineitem GROUP BY 1")
def a12_count_report(t):
    return graph.count_report(t.lineitem.select(F.col("l_returnflag").alias("label"), "l_partkey"), "label", "l_partkey")


@query("SELECT label, node_ref, row_number() OVER (ORDER BY label, node_ref) - 1 AS node_id, row_number() OVER (PARTITION BY label ORDER BY node_ref) - 1 AS local_id FROM (SELECT 'Compound' AS label, 'Compound|cid=' || p_partkey AS node_ref FROM part UNION ALL SELECT 'Protein', 'Protein|protein_id=' || s_suppkey FROM supplier)")
def ow7_dense_node_ids(t):
    nodes = t.part.select(F.lit("Compound").alias("label"), X.node_ref("Compound", cid="p_partkey").alias("node_ref"))
    nodes = nodes.unionByName(t.supplier.select(F.lit("Protein").alias("label"), X.node_ref("Protein", protein_id="s_suppkey").alias("node_ref")))
    return graph.local_ids(graph.dense_ids(nodes, ["label", "node_ref"]), "label", "node_id")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM lineitem) WHERE k <= 5")
def ow1_capped_per_key(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return graph.capped(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], 5)


@query(over_views("SELECT node, count(*) AS degree FROM (SELECT a AS node FROM similar_to UNION ALL SELECT b FROM similar_to) GROUP BY 1"))
def a9_similarity_degree(t):
    return graph.degrees(t.similar_to, "a", "b")


@query("SELECT c_mktsegment AS start_label, o_orderstatus AS type, o_orderpriority AS end_label, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3")
def a22_schema_counts(t):
    edges = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("start_label"), F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("end_label"))
    return graph.schema_counts(edges)


@query("SELECT n_name AS name, 'missing' AS status FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 4 = 0) UNION ALL SELECT DISTINCT 'key ' || s_nationkey, 'extra' FROM supplier WHERE s_suppkey % 4 = 0 AND s_nationkey % 7 = 0")
def u5_schema_alignment(t):
    seen = t.supplier.filter("s_suppkey % 4 = 0").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    extra = seen.filter("s_nationkey % 7 = 0").select(F.concat(F.lit("key "), F.col("s_nationkey").cast("string")).alias("name"))
    return graph.schema_alignment(seen.select(F.col("n_name").alias("name")).unionByName(extra), t.nation.select(F.col("n_name").alias("name")), ["name"])


@query("SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 AND o_orderkey % 4 = 0 THEN 'cust,clerk' WHEN o_custkey % 5 = 0 THEN 'cust' ELSE 'clerk' END AS missing_keys FROM orders WHERE o_custkey % 5 = 0 OR o_orderkey % 4 = 0")
def p7_missing_keys(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("cust"), F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise("x").alias("clerk"))
    return graph.missing_keys(rows, ["cust", "clerk"]).select("o_orderkey", "missing_keys")


@query(over_views("SELECT 'Compound|cid=' || a AS start_ref, 'Compound|cid=' || b AS end_ref, 'SIMILAR_TO' AS type FROM similar_to UNION ALL SELECT 'Compound|cid=' || b, 'Compound|cid=' || a, 'SIMILAR_TO' FROM similar_to UNION ALL SELECT 'MeasureGrp|mg_id=' || mg_id, 'Protein|protein_id=' || protein_id, 'TESTED_ON' FROM tested_on UNION ALL SELECT 'Protein|protein_id=' || protein_id, 'MeasureGrp|mg_id=' || mg_id, 'rev_TESTED_ON' FROM tested_on"))
def j34_reverse_edges(t):
    same = t.similar_to.select(X.node_ref("Compound", cid="a").alias("start_ref"), X.node_ref("Compound", cid="b").alias("end_ref"), F.lit("SIMILAR_TO").alias("type"))
    tested = t.tested_on.select(X.node_ref("MeasureGrp", mg_id="mg_id").alias("start_ref"), X.node_ref("Protein", protein_id="protein_id").alias("end_ref"), F.lit("TESTED_ON").alias("type"))
    return graph.reversed_edges(same.unionByName(tested))


@query("SELECT CAST('core' AS VARCHAR) AS layer, p_partkey AS k, p_name AS name, NULL AS score FROM part UNION ALL SELECT 'text', s_suppkey, NULL, s_acctbal FROM supplier")
def u1_layers(t):
    return graph.layered(("core", t.part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))), ("text", t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("score"))))


EXTRACTED = ("compound", "protein", "measuregroup", "mg_protein", "endpoint")


def extracted_rows(t: Tables) -> DataFrame:
    """Rows of several kinds as an extractor would append them."""
    text = lambda c: F.col(c).cast("string")
    row = lambda df, kind, seq, **data: df.select(F.lit(kind).alias("kind"), F.create_map(*(x for k, v in data.items() for x in (F.lit(k), v))).alias("data"), F.col(seq).cast("long").alias("seq"))
    similar = F.concat(text("p_partkey"), F.lit(" | "), (F.col("p_partkey") + 1).cast("string"))
    smiles = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("C"), text("p_size"))).otherwise(" ")
    parts = [
        row(t.part, "compound", "p_partkey", cid=text("p_partkey"), title=text("p_name"), smiles=smiles, similar_compounds=similar),
        row(t.supplier, "protein", "s_suppkey", protein_id=text("s_suppkey"), label=text("s_name"), taxid=text("s_nationkey")),
        row(t.orders, "measuregroup", "o_orderkey", mg_id=text("o_orderkey"), aid=text("o_custkey")),
        row(t.tested_on, "mg_protein", "mg_id", mg_id=text("mg_id"), protein_id=text("protein_id")),
        row(t.endpoint, "endpoint", "mg_id", endpoint_id=text("endpoint_id"), type=text("endpoint_type"), sid=text("sid"), mg_id=text("mg_id")),
    ]
    return graph.layered(*((str(i), p) for i, p in enumerate(parts))).drop("layer")


@query("""SELECT label, node_ref, n_props FROM (
  SELECT 'Compound' AS label, 'Compound|cid=' || p_partkey AS node_ref, 1 AS n_props FROM part UNION ALL SELECT 'Structure', 'Structure|cid=' || p_partkey, 2 FROM part WHERE p_partkey % 2 = 0
  UNION ALL SELECT 'Protein', 'Protein|protein_id=' || s_suppkey, 2 FROM supplier UNION ALL SELECT 'MeasureGrp', 'MeasureGrp|mg_id=' || o_orderkey, 0 FROM orders
  UNION ALL SELECT 'Endpoint', 'Endpoint|endpoint_id=' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey), CASE WHEN l_linenumber % 7 = 6 THEN 0 ELSE 1 END FROM lineitem)""")
def m1_nodes_of_rows(t):
    return mapping.nodes_of(extracted_rows(t), EXTRACTED).select("label", "node_ref", F.size("props").alias("n_props"))


@query("""SELECT type, start_ref, end_ref FROM (
  SELECT 'SIMILAR_TO' AS type, 'Compound|cid=' || p_partkey AS start_ref, 'Compound|cid=' || (p_partkey + 1) AS end_ref FROM part
  UNION ALL SELECT 'HAS_STRUCTURE', 'Compound|cid=' || p_partkey, 'Structure|cid=' || p_partkey FROM part WHERE p_partkey % 2 = 0
  UNION ALL SELECT 'HAS_MEASURE_GROUP', 'BioAssay|aid=' || o_custkey, 'MeasureGrp|mg_id=' || o_orderkey FROM orders
  UNION ALL SELECT DISTINCT 'TESTED_ON', 'MeasureGrp|mg_id=' || l_orderkey, 'Protein|protein_id=' || l_suppkey FROM lineitem
  UNION ALL SELECT 'ABOUT_SUBSTANCE', 'Endpoint|endpoint_id=' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey), 'Substance|sid=' || (l_partkey * 10 + l_linenumber) FROM lineitem
  UNION ALL SELECT 'HAS_ENDPOINT', 'MeasureGrp|mg_id=' || l_orderkey, 'Endpoint|endpoint_id=' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) FROM lineitem)""")
def m9_edges_of_rows(t):
    return mapping.edges_of(extracted_rows(t), EXTRACTED).drop("seq")


# Components and splits ----------------------------------------------------------------------------------------

COMPONENTS_SQL = """, links AS (SELECT a, b FROM similar_to UNION ALL SELECT b, a FROM similar_to),
reach(node, other) AS (SELECT cid, cid FROM compound UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
parts AS (SELECT *, CAST('0x' || substr(sha1('Compound|cid=' || component), 1, 8) AS BIGINT) % 10 AS bucket FROM comp),
splits AS (SELECT node, component, CASE WHEN bucket < 7 THEN 'train' WHEN bucket < 9 THEN 'val' ELSE 'test' END AS split FROM parts)
"""


def compound_components(t: Tables) -> DataFrame:
    return components.connected_components(t.compound.select(F.col("cid").alias("node")), t.similar_to)


@query(over_views(COMPONENTS_SQL + "SELECT * FROM comp"))
def g1_connected_components(t):
    return compound_components(t)


@query(over_views(COMPONENTS_SQL + "SELECT * FROM splits"))
def g2_component_split(t):
    return components.component_split(compound_components(t))


@query(over_views("SELECT degree, count(*) AS n FROM (SELECT node, count(*) AS degree FROM (SELECT a AS node FROM similar_to UNION ALL SELECT b FROM similar_to) GROUP BY 1) GROUP BY 1"))
def g4_degree_distribution(t):
    return graph.degrees(t.similar_to, "a", "b").groupBy("degree").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN b < 7 THEN 'train' WHEN b < 9 THEN 'val' ELSE 'test' END AS split FROM (SELECT p_partkey, CAST('0x' || substr(sha1('Compound|cid=' || p_partkey), 1, 8) AS BIGINT) % 10 AS b FROM part)")
def x12_deterministic_split(t):
    return t.part.select("p_partkey", X.split_of(X.node_ref("Compound", cid="p_partkey")).alias("split"))


U6_SQL = """WITH d AS (SELECT DISTINCT l_partkey AS k, CASE l_returnflag WHEN 'A' THEN 'test' WHEN 'N' THEN 'train' ELSE 'val' END AS s FROM lineitem), n AS (SELECT s, count(*) AS n FROM d GROUP BY 1),
p AS (SELECT x.s AS a, y.s AS b, count(*) AS n_shared FROM d x JOIN d y ON x.k = y.k AND x.s < y.s GROUP BY 1, 2)
SELECT x.s AS a, y.s AS b, x.n AS n_a, y.n AS n_b, coalesce(p.n_shared, 0) AS n_shared, round(100 * coalesce(p.n_shared, 0) / least(x.n, y.n), 3) AS percent_shared,
  CASE WHEN 100 * coalesce(p.n_shared, 0) / least(x.n, y.n) >= 5 THEN 'high' WHEN coalesce(p.n_shared, 0) > 0 THEN 'warning' ELSE 'low' END AS risk
FROM n x JOIN n y ON x.s < y.s LEFT JOIN p ON p.a = x.s AND p.b = y.s"""


@query(U6_SQL)
def u6_split_overlap(t):
    split = F.when(F.col("l_returnflag") == "A", "test").when(F.col("l_returnflag") == "N", "train").otherwise("val")
    return quality.split_overlap(t.lineitem.select(F.col("l_partkey").alias("k"), split.alias("s")), "k", "s")


@query(over_views(COMPONENTS_SQL + """, held AS (SELECT DISTINCT e.mg_id FROM endpoint e JOIN substance s USING (sid) JOIN splits x ON x.node = s.cid WHERE x.split <> 'train' AND e.mg_id % 5 = 0)
SELECT t.mg_id AS "start", t.protein_id AS "end", CASE WHEN t.mg_id IN (SELECT mg_id FROM held) THEN 'removed' WHEN t.protein_id % 10 = 0 THEN 'transductive_safe' ELSE 'train_only' END AS part FROM tested_on t"""))
def u8_edge_partition(t):
    split = components.component_split(compound_components(t)).filter("split != 'train'").select(F.col("node").alias("cid"))
    held = t.endpoint.filter("mg_id % 5 = 0").join(t.substance, "sid").join(split, "cid").select(F.concat(F.lit("g"), F.col("mg_id").cast("string")).alias("ref")).distinct()
    cold = t.protein.filter("protein_id % 10 = 0").select(F.concat(F.lit("p"), F.col("protein_id").cast("string")).alias("ref"))
    edges = t.tested_on.select(F.concat(F.lit("g"), F.col("mg_id").cast("string")).alias("start"), F.concat(F.lit("p"), F.col("protein_id").cast("string")).alias("end"))
    found = evidence.edge_partition(edges, held, cold)
    return found.select(F.substring("start", 2, 30).cast("long").alias("start"), F.substring("end", 2, 30).cast("long").alias("end"), "part")


# Features -----------------------------------------------------------------------------------------------------


@query("""
WITH f AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp FROM part WHERE p_partkey % 3 = 0)
SELECT p_partkey, round((coalesce(CASE WHEN p_partkey % 11 <> 0 THEN p_size END, ms) - ms) / ss, 4) AS x_size, CAST(p_partkey % 11 = 0 AS INTEGER) AS missing_size, round((p_retailprice - mp) / sp, 4) AS x_price, 0 AS missing_price
FROM part, (SELECT avg(p_size) FILTER (WHERE p_partkey % 11 <> 0) AS ms, stddev_pop(p_size) FILTER (WHERE p_partkey % 11 <> 0) AS ss, avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp FROM part WHERE p_partkey % 3 = 0)
""")
def e5_model_matrix(t):
    rows = t.part.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")).cast("string").alias("size"), F.col("p_retailprice").alias("price"))
    found = features.model_matrix(rows, ["p_partkey"], rows.filter("p_partkey % 3 = 0"))
    return found.select("p_partkey", F.round("x_size", 4).alias("x_size"), "missing_size", F.round("x_price", 4).alias("x_price"), "missing_price")


@query("""WITH v AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 11 <> 0 THEN p_size END AS size, p_retailprice AS price FROM part),
s AS (SELECT avg(size) AS ms, stddev_pop(size) AS ss, avg(price) AS mp, stddev_pop(price) AS sp FROM v WHERE p_partkey % 3 = 0)
SELECT p_partkey, p_name, CAST(size AS VARCHAR) AS size, price, round((coalesce(size, ms) - ms) / ss, 4) AS z_size, CAST(size IS NULL AS INTEGER) AS z_size_missing, round((price - mp) / sp, 4) AS z_price, 0 AS z_price_missing FROM v, s""")
def e4_augmented_zscores(t):
    rows = t.part.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")).cast("string").alias("size"), F.col("p_retailprice").alias("price"))
    found = features.with_zscores(rows, ["p_partkey"], rows.filter("p_partkey % 3 = 0"))
    return found.withColumns({c: F.round(c, 4) for c in ("z_size", "z_price")})


def feature_tables(t: Tables) -> dict[str, DataFrame]:
    compounds = t.part.select(F.col("p_partkey").alias("node_id"), "p_name", F.when(F.col("p_partkey") % 7 > 0, F.col("p_size").cast("string")).otherwise(" ").alias("size"), (F.col("p_size") % 3 == 0).alias("flag"), (F.col("p_size") % 2).alias("fp_1"), F.lit(1.5).alias("constant"))
    endpoints = t.lineitem.select(F.col("l_orderkey").alias("node_id"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).alias("emb_0"), F.when(F.col("l_linenumber") > 3, F.col("l_tax")).alias("tax"), F.col("l_returnflag"))
    return {"compound": compounds, "endpoint": endpoints}


FEATURE_TABLES_SQL = """WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE p_partkey % 7 = 0) AS size, count(*) FILTER (WHERE p_partkey % 7 > 0 AND p_size = 0) AS size0, count(*) FILTER (WHERE p_size % 2 = 0) AS fp0, var_samp(p_size % 2) AS fp_v, var_samp(CASE WHEN p_partkey % 7 > 0 THEN p_size END) AS size_v FROM part),
e AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber % 2 = 1) AS emb, count(*) FILTER (WHERE l_linenumber <= 3) AS tax, count(*) FILTER (WHERE l_linenumber > 3 AND l_tax = 0) AS tax0, count(*) FILTER (WHERE l_linenumber % 2 = 0 AND l_quantity = 0) AS emb0 FROM lineitem)
"""


@query(FEATURE_TABLES_SQL + """SELECT 'compound' AS "table", n AS "rows", 6 AS columns, 3 AS numeric_columns, 1 AS vector_like_columns, size AS missing_cells, round(100 * size / (6 * n), 3) AS missing_cell_percent FROM c
UNION ALL SELECT 'endpoint', n, 4, 2, 1, emb + tax, round(100 * (emb + tax) / (4 * n), 3) FROM e""")
def q11_feature_tables(t):
    return features.table_summary(feature_tables(t))


@query(FEATURE_TABLES_SQL + """SELECT "table", feature, percent AS missing_percent FROM (SELECT 'compound' AS "table", 'size' AS feature, round(100 * size / n, 3) AS percent FROM c UNION ALL SELECT 'compound', 'constant', 0 FROM c UNION ALL SELECT 'endpoint', 'tax', round(100 * tax / n, 3) FROM e UNION ALL SELECT 'endpoint', 'emb_0', round(100 * emb / n, 3) FROM e)""")
def q11_most_missing(t):
    return features.top_missing(feature_tables(t), 2)


@query(FEATURE_TABLES_SQL + """SELECT 'compound' AS "table", n AS "rows", 6 AS columns, 3 AS numeric_columns, 1 AS zero_variance_numeric_columns, size AS nan_count, round(100 * (size + size0 + fp0) / (3 * n), 3) AS zero_numeric_cell_percent FROM c
UNION ALL SELECT 'endpoint', n, 4, 2, 0, emb + tax, round(100 * (emb + tax + tax0 + emb0) / (2 * n), 3) FROM e""")
def q18_matrix_quality(t):
    return features.matrix_summary(feature_tables(t))


@query(FEATURE_TABLES_SQL + """SELECT 'fp_1' AS feature, fp_v AS variance FROM c UNION ALL SELECT 'size', size_v FROM c UNION ALL SELECT 'constant', 0""")
def q18_top_variance(t):
    return features.top_variance(feature_tables(t)["compound"], ["size", "fp_1", "constant"], 3)


@query("SELECT * FROM (SELECT 'p_size' AS feature, count(p_size) AS n, CAST(min(p_size) AS DOUBLE) AS min, CAST(median(p_size) AS DOUBLE) AS median, round(avg(p_size), 6) AS mean, CAST(max(p_size) AS DOUBLE) AS max FROM part UNION ALL SELECT 'p_retailprice', count(p_retailprice), min(p_retailprice), median(p_retailprice), round(avg(p_retailprice), 6), max(p_retailprice) FROM part)")
def a15_numeric_summary(t):
    return features.numeric_summary(t.part, ["p_size", "p_retailprice"]).withColumn("mean", F.round("mean", 6))


@query("SELECT 'l_tax' AS feature, count(*) AS n_present, count(*) FILTER (WHERE l_tax <> 0) AS n_nonzero, 0 AS n_missing, count(*) AS n_rows, 100.0::DOUBLE AS percent_present FROM lineitem UNION ALL SELECT 'd', count(*) FILTER (WHERE l_linenumber < 4), count(*) FILTER (WHERE l_linenumber < 4 AND l_discount <> 0), count(*) FILTER (WHERE l_linenumber >= 4), count(*), round(100 * count(*) FILTER (WHERE l_linenumber < 4) / count(*), 3) FROM lineitem")
def a17_coverage(t):
    return features.coverage(t.lineitem.select("l_tax", F.when(F.col("l_linenumber") < 4, F.col("l_discount")).alias("d")), ["l_tax", "d"])


@query("SELECT 'l_tax' AS feature, round(var_samp(l_tax), 8) AS variance, 0 AS n_missing, round(100.0 * count(*) FILTER (WHERE l_tax = 0) / count(*), 3) AS percent_zero, false AS constant FROM lineitem UNION ALL SELECT 'one', 0, 0, 0, true")
def a21_matrix_quality(t):
    return features.matrix_quality(t.lineitem.select("l_tax", F.lit(1).alias("one")), ["l_tax", "one"]).withColumn("variance", F.round("variance", 8))


@query("SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem")
def e9_correlation(t):
    return features.correlation(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"]).withColumn("r", F.round("r", 6))


@query("SELECT CAST(CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 50 THEN 11 ELSE floor(l_quantity / 5) + 1 END AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def e10_histogram(t):
    return features.histogram(t.lineitem, "l_quantity", 0.0, 50.0, 10)


@query("SELECT l_returnflag, min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q1, median(l_quantity) AS median, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS max, count(*) AS n FROM lineitem GROUP BY 1")
def e10_quantiles(t):
    return features.quantiles(t.lineitem, "l_returnflag", "l_quantity")


@query()
def e8_principal_components(t):
    wide = t.embeddings.select("vec_id", *(F.get("embedding", F.lit(i)).alias(f"e{i}") for i in range(8)))
    return features.principal_components(wide, "vec_id", [f"e{i}" for i in range(8)])


@query("SELECT vec_id, max(embedding[1]) FILTER (WHERE label % 2 = 0) AS even_0000, max(embedding[2]) FILTER (WHERE label % 2 = 0) AS even_0001, max(embedding[1]) FILTER (WHERE label % 2 <> 0) AS odd_0000, max(embedding[2]) FILTER (WHERE label % 2 <> 0) AS odd_0001 FROM embeddings GROUP BY vec_id")
def e7_embedding_columns(t):
    rows = t.embeddings.withColumn("m", F.when(F.col("label") % 2 == 0, "even").otherwise("odd"))
    return features.embedding_columns(rows, "vec_id", "m", "embedding", 2, ["even", "odd"])


# Descriptors and similarity -----------------------------------------------------------------------------------


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS c, CAST(p_partkey % 30 + 1 AS BIGINT) AS cl, CAST(3 AS BIGINT) AS o FROM part")
def x4_formula_elements(t):
    formula = F.concat(F.lit("C"), F.col("p_size").cast("string"), F.lit("Cl"), (F.col("p_partkey") % 30 + 1).cast("string"), F.lit("OH2O2"))
    counts = D.element_counts(formula)
    return t.part.select("p_partkey", counts["C"].alias("c"), counts["Cl"].alias("cl"), counts["O"].alias("o"))


@query("SELECT p_partkey, CAST(length(s) AS BIGINT) AS n, CAST(length(s) - length(replace(s, 'A', '')) AS BIGINT) AS aa_a, round((length(s) - length(replace(s, 'L', ''))) / nullif(length(s), 0), 6) AS freq_l, round((length(s) - length(regexp_replace(s, '[DEKRH]', '', 'g'))) / nullif(length(s), 0), 6) AS charged FROM (SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS s FROM part)")
def x5_sequence_composition(t):
    s = D.clean_sequence("p_name")
    parts = D.composition(s)
    return t.part.select("p_partkey", F.length(s).cast("long").alias("n"), parts["aa_A"].cast("long").alias("aa_a"), parts["freq_L"].alias("freq_l"), parts["charged_fraction"].alias("charged"))


BITS_SQL = """WITH g AS (
  SELECT p_partkey AS id, '^' || p_name || '$' AS s FROM part
), h AS (
  SELECT DISTINCT id, CAST('0x' || substr(sha1(substr(s, i, n)), 1, 8) AS BIGINT) % 256 AS bit
  FROM (SELECT id, s, n, unnest(range(1, length(s) - n + 2)) AS i FROM g, (SELECT unnest([2, 3, 4]) AS n))
), c AS (SELECT id, count(*) AS n FROM h GROUP BY id)"""


@query(BITS_SQL + " SELECT id, CAST(count(*) AS INTEGER) AS n_bits, CAST(sum(bit) AS BIGINT) AS sum_bits FROM h GROUP BY id")
def x6_fingerprint(t):
    prints = similarity.with_bits(t.part, "p_partkey", "p_name")
    return prints.select("id", F.size("bits").alias("n_bits"), F.aggregate("bits", F.lit(0).cast("long"), lambda s, b: s + b).alias("sum_bits"))


@query(BITS_SQL + " SELECT CAST(bit AS INTEGER) AS bit, count(*) AS n FROM h GROUP BY bit")
def a20_bit_frequency(t):
    return similarity.with_bits(t.part, "p_partkey", "p_name").select(F.explode("bits").alias("bit")).groupBy("bit").agg(F.count("*").alias("n"))


@query(BITS_SQL + """, p AS (SELECT x.id, y.id AS other, count(*) AS k FROM h x JOIN h y USING (bit) WHERE x.id <> y.id GROUP BY 1, 2),
s AS (SELECT p.id, other, k / (a.n + b.n - k) AS score FROM p JOIN c a ON a.id = p.id JOIN c b ON b.id = p.other WHERE k / (a.n + b.n - k) >= 0.6)
SELECT id, other, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS r FROM s) WHERE r <= 5""")
def g5_similar_compounds(t):
    return similarity.neighbours(similarity.with_bits(t.part, "p_partkey", "p_name"), 0.6, 5)


@query(BITS_SQL.replace("WITH g", "WITH e AS (SELECT a, b FROM (SELECT p_partkey AS a, lead(p_partkey) OVER (PARTITION BY p_brand, p_type, p_size // 10 ORDER BY p_partkey) AS b FROM part) WHERE b IS NOT NULL), g", 1) + """
SELECT a, b, coalesce(k, 0) / (x.n + y.n - coalesce(k, 0)) AS score FROM e LEFT JOIN (SELECT a, b, count(*) AS k FROM e JOIN h p ON p.id = a JOIN h q ON q.id = b AND q.bit = p.bit GROUP BY 1, 2) USING (a, b) JOIN c x ON x.id = a JOIN c y ON y.id = b""")
def g6_edge_tanimoto(t):
    return similarity.edge_scores(t.similar_to, similarity.with_bits(t.part, "p_partkey", "p_name"))


@query("""WITH terms AS (SELECT DISTINCT lower(w) AS phrase FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM benchmark) WHERE length(w) BETWEEN 4 AND 5),
d AS (SELECT doc_id, list_distinct(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS ws FROM documents)
SELECT doc_id, phrase AS term_id FROM (SELECT doc_id, phrase, row_number() OVER (PARTITION BY doc_id ORDER BY phrase) AS k FROM d JOIN terms ON list_contains(ws, phrase)) WHERE k <= 25""")
def g7_term_mentions(t):
    return found_terms(t).select("doc_id", "term_id")


def found_terms(t: Tables) -> DataFrame:
    words = t.benchmark.select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"))).alias("w")).filter(F.length("w").between(4, 5))
    terms = words.select(F.lower("w").alias("phrase")).distinct().select(F.col("phrase").alias("term_id"), "phrase")
    return similarity.mentions(t.documents.select("doc_id", "text"), terms, "doc_id", 25)


@query("""WITH terms AS (SELECT DISTINCT lower(w) AS phrase FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM benchmark) WHERE length(w) BETWEEN 4 AND 5),
d AS (SELECT doc_id, list_distinct(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS ws FROM documents),
m AS (SELECT doc_id, phrase FROM (SELECT doc_id, phrase, row_number() OVER (PARTITION BY doc_id ORDER BY phrase) AS k FROM d JOIN terms ON list_contains(ws, phrase)) WHERE k <= 25),
p AS (SELECT a.doc_id, a.phrase AS left_id, b.phrase AS right_id FROM m a JOIN m b USING (doc_id) WHERE length(a.phrase) = 4 AND length(b.phrase) = 5)
SELECT left_id, right_id, doc_id, 'comention:' || substr(sha1(left_id || '|' || right_id || '|' || doc_id), 1, 16) AS mention_id, CAST(0.25 AS DOUBLE) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY left_id, right_id ORDER BY doc_id) AS k FROM p) WHERE k <= 10""")
def g7_comentions(t):
    found = found_terms(t)
    return similarity.comentions(found.filter("length(term_id) = 4"), found.filter("length(term_id) = 5"), "doc_id", 10)


@query("""WITH r AS (SELECT p_partkey, list_filter(list_concat([trim(p_name), trim(p_type)], list_transform(string_split('CID ' || p_partkey || ' | ' || lower(p_brand) || ' | Unknown | ' || p_type || ' |  ab | ' || p_name || ' salt', '|'), lambda x: trim(x))),
  lambda x: length(x) BETWEEN 4 AND 80 AND NOT starts_with(lower(x), 'cid ') AND lower(x) NOT IN ('compound', 'chemical', 'unknown', 'untitled')) AS ts FROM part),
e AS (SELECT p_partkey, unnest(ts) AS term, unnest(range(len(ts))) AS i FROM r), f AS (SELECT p_partkey, term, min(i) AS i FROM e GROUP BY 1, 2)
SELECT p_partkey AS term_id, place, term, lower(term) AS phrase FROM (SELECT p_partkey, term, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY i) - 1 AS INTEGER) AS place FROM f) WHERE place < 12""")
def x10_term_dictionary(t):
    key = F.col("p_partkey").cast("string")
    synonyms = F.concat(F.lit("CID "), key, F.lit(" | "), F.lower("p_brand"), F.lit(" | Unknown | "), F.col("p_type"), F.lit(" |  ab | "), F.col("p_name"), F.lit(" salt"))
    return similarity.compound_dictionary(t.part.withColumn("synonyms", synonyms), "p_partkey", "p_partkey", ["p_name", "p_type"], ["synonyms"])


# Identifiers and text -----------------------------------------------------------------------------------------


@query("SELECT s_suppkey, 'ep:' || substr(sha1(s_suppkey || '|' || '|' || s_name), 1, 16) AS id, nullif(regexp_replace(s_name || ' (x)', '[^A-Za-z0-9:_.-]+', '', 'g'), '') AS clean FROM supplier")
def t13_stable_ids(t):
    return t.supplier.select("s_suppkey", X.stable_id("s_suppkey", F.lit(None), "s_name", prefix="ep:", digits=16).alias("id"), X.identifier(F.concat("s_name", F.lit(" (x)"))).alias("clean"))


@query("SELECT DISTINCT c_mktsegment AS label, upper(regexp_replace(c_mktsegment || ' by', '[^A-Za-z0-9]+', '_', 'g')) AS rel_type FROM customer")
def t14_relationship_type(t):
    return t.customer.select(F.col("c_mktsegment").alias("label"), X.relationship_type(F.concat("c_mktsegment", F.lit(" by (old)"))).alias("rel_type")).distinct()


@query("SELECT p_partkey, 'Pair' AS label, CAST(p_size AS VARCHAR) AS size FROM part")
def t17_node_refs(t):
    ref = X.node_ref("Pair", size="p_size", cid="p_partkey")
    return t.part.select(X.ref_keys(ref)["cid"].cast("long").alias("p_partkey"), X.ref_label(ref).alias("label"), X.ref_keys(ref)["size"].alias("size"))


@query("SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'P10635' WHEN 1 THEN 'P08684' WHEN 2 THEN 'Q7Z449' END AS accession, CASE s_suppkey % 5 WHEN 0 THEN 'CYP2D6' WHEN 1 THEN 'CYP3A4' WHEN 2 THEN 'CYP2U1' WHEN 3 THEN 'CYP2C9' WHEN 4 THEN 'CYP1A2' END AS symbol FROM supplier")
def t5_target_symbols(t):
    text = F.get(F.array(*map(F.lit, ["protein:ACCP10635", "https://x.example.org/p08684-2", "ACCQ7Z449", "Cytochrome P450 family 2 subfamily C member 9", "cyp-1a2 (human)"])), F.col("s_suppkey") % 5)
    return t.supplier.select("s_suppkey", T.accession(text).alias("accession"), T.cyp_symbol(text).alias("symbol"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'cid' WHEN 1 THEN 'sid' WHEN 2 THEN 'inchikey' WHEN 3 THEN 'inchi' ELSE 'smiles' END AS kind, CASE p_partkey % 5 WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN 'ABCDEFGHIJKLMN-ABCDEFGHIJ-N' WHEN 3 THEN 'InChI=1S/' || p_partkey ELSE 'CCO' || p_partkey || 'N' END AS id FROM part")
def t6_chemical_seeds(t):
    k = F.col("p_partkey").cast("string")
    text = F.get(F.array(F.concat(F.lit("compound:CID"), k), F.concat(F.lit("SID"), k), F.lit("abcdefghijklmn-abcdefghij-n"), F.concat(F.lit("InChI=1S/"), k), F.concat(F.lit("CCO"), k, F.lit("N"))), F.col("p_partkey") % 5)
    seed = T.chemical_seed(text)
    return t.part.select("p_partkey", seed["kind"].alias("kind"), seed["id"].alias("id"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'PMID:' || o_custkey WHEN 1 THEN 'DOI:10.1000/x' || o_custkey ELSE 'patent/US' || o_custkey END AS identity, CASE o_orderkey % 3 WHEN 0 THEN 'pubmed' WHEN 1 THEN 'external' ELSE 'patent' END AS kind FROM orders")
def r1_reference_identity(t):
    k = F.col("o_custkey").cast("string")
    raw = F.get(F.array(F.concat(F.lit("reference/PMID_"), k), F.concat(F.lit("see 10.1000/x"), k), F.concat(F.lit("patent/US"), k)), F.col("o_orderkey") % 3)
    none = F.lit(None).cast("string")
    return t.orders.select("o_orderkey", T.reference_identity(none, none, raw).alias("identity"), T.reference_type(none, none, raw).alias("kind"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(s, 'binding|bind|affinity|ki|kd') THEN 'binding' WHEN regexp_matches(s, 'inhib|ic50') THEN 'inhibition' WHEN regexp_matches(s, 'activat|agonist') THEN 'activation' WHEN regexp_matches(s, 'metabol|substrate|turnover|clearance') THEN 'metabolism'
 WHEN regexp_matches(s, 'enzyme|catalytic|km|vmax') THEN 'enzyme_activity' WHEN regexp_matches(s, 'cell') THEN 'cell_based' WHEN regexp_matches(s, 'tox|viability') THEN 'toxicity' ELSE 'unspecified' END AS kind
FROM (SELECT p_partkey, lower(p_name || ' ' || CASE p_partkey % 4 WHEN 0 THEN 'Cellular assay' WHEN 1 THEN 'IC50' WHEN 2 THEN 'Kinase' ELSE '' END) AS s FROM part)""")
def r5_assay_type(t):
    more = F.get(F.array(F.lit("Cellular assay"), F.lit("IC50"), F.lit("Kinase"), F.lit("")), F.col("p_partkey") % 4)
    return t.part.select("p_partkey", T.assay_type("p_name", more).alias("kind"))


# Traversals over triples --------------------------------------------------------------------------------------


def triples(t: Tables) -> DataFrame:
    """The evidence of the tables as triples."""
    P = extract.PREDICATES
    name = lambda kind, c: F.concat(F.lit(f"{kind}:"), c.cast("string"))
    e, c = t.endpoint, F.col
    parts = [
        t.tested_on.select(name("mg", c("mg_id")).alias("s"), F.lit(P["participant"]).alias("p"), name("protein", c("protein_id")).alias("o")),
        e.select(name("mg", c("mg_id")).alias("s"), F.lit(P["output"]).alias("p"), name("endpoint", c("endpoint_id")).alias("o")),
        e.select(name("endpoint", c("endpoint_id")).alias("s"), F.lit(P["about"]).alias("p"), name("sid", c("sid")).alias("o")),
        t.substance.select(name("sid", c("sid")).alias("s"), F.lit(P["standardized"]).alias("p"), name("cid", c("cid")).alias("o")),
        t.measuregroup.select(name("aid", c("aid")).alias("s"), F.lit(P["assay_group"]).alias("p"), name("mg", c("mg_id")).alias("o")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(over_views("SELECT 'mg:' || mg_id AS s, 'protein:' || protein_id AS o FROM (SELECT mg_id, protein_id, row_number() OVER (PARTITION BY mg_id ORDER BY 'protein:' || protein_id) AS k FROM tested_on WHERE mg_id % 10 = 0) WHERE k <= 2"))
def j1_forward_hop(t):
    seeds = t.measuregroup.filter("mg_id % 10 = 0").select(F.concat(F.lit("mg:"), F.col("mg_id").cast("string")).alias("s"))
    return extract.objects_of(seeds, triples(t), "participant", 2)


@query(over_views("SELECT 'mg:' || mg_id AS s, 'protein:' || protein_id AS o FROM tested_on WHERE protein_id % 10 = 0"))
def j2_inverse_hop(t):
    seeds = t.protein.filter("protein_id % 10 = 0").select(F.concat(F.lit("protein:"), F.col("protein_id").cast("string")).alias("o"))
    return extract.subjects_of(seeds, triples(t), "participant")


@query(over_views("""SELECT 'mg:' || e.mg_id AS mg, 'endpoint:' || e.endpoint_id AS endpoint, 'sid:' || e.sid AS substance, 'cid:' || s.cid AS compound, 'protein:' || t.protein_id AS target, 'aid:' || m.aid AS assay
FROM endpoint e JOIN substance s USING (sid) JOIN tested_on t ON t.mg_id = e.mg_id LEFT JOIN measuregroup m ON m.mg_id = e.mg_id WHERE t.protein_id % 10 = 0 AND s.cid % 2 = 0"""))
def j13_evidence_star(t):
    every = triples(t)
    targets = t.protein.filter("protein_id % 10 = 0").select(F.concat(F.lit("protein:"), F.col("protein_id").cast("string")).alias("o"))
    allowed = extract.subjects_of(targets, every, "participant").select(F.col("s").alias("mg"), F.col("o").alias("target"))
    compounds = t.compound.filter("cid % 2 = 0").select(F.concat(F.lit("cid:"), F.col("cid").cast("string")).alias("compound"))
    return extract.evidence_rows(every, allowed, compounds)


@query(over_views("SELECT 'mg:' || mg_id AS s, 'protein:' || protein_id AS o FROM (SELECT mg_id, protein_id, row_number() OVER (PARTITION BY mg_id ORDER BY 'protein:' || protein_id) AS k FROM tested_on) WHERE k <= 2"))
def j1_forward_hop_of_all_groups(t):
    seeds = t.measuregroup.select(F.concat(F.lit("mg:"), F.col("mg_id").cast("string")).alias("s"))
    return extract.objects_of(seeds, triples(t), "participant", 2)


@query(over_views("SELECT 'mg:' || mg_id AS s, 'protein:' || protein_id AS o FROM tested_on"))
def j2_inverse_hop_of_all_proteins(t):
    seeds = t.protein.select(F.concat(F.lit("protein:"), F.col("protein_id").cast("string")).alias("o"))
    return extract.subjects_of(seeds, triples(t), "participant")


@query(over_views("""SELECT DISTINCT 'mg:' || e.mg_id AS mg, 'endpoint:' || e.endpoint_id AS endpoint, 'sid:' || e.sid AS substance, 'cid:' || s.cid AS compound, 'protein:' || t.protein_id AS target, 'aid:' || m.aid AS assay
FROM endpoint e JOIN substance s USING (sid) JOIN tested_on t ON t.mg_id = e.mg_id LEFT JOIN measuregroup m ON m.mg_id = e.mg_id"""))
def j13_evidence_star_of_all_keys(t):
    return extract.evidence_rows(triples(t))


@query(over_views("SELECT * FROM tested_on WHERE mg_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 4 <> 0)"))
def j8_taxonomy_filter(t):
    organisms = t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("mg_id"), (F.col("o_custkey") % 4).alias("taxid"))
    return extract.in_taxa(t.tested_on, "mg_id", organisms, [0])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS k FROM orders WHERE o_orderkey % 3 = 0 OR o_custkey % 2 = 0")
def j9_null_tolerant_semi_join(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("k"))
    return extract.known_or_missing(rows, "k", t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")))


@query("SELECT kind, id, min(seq) AS first_seq FROM (SELECT 'compound' AS kind, CAST(l_partkey AS VARCHAR) AS id, l_orderkey * 10 + l_linenumber AS seq FROM lineitem UNION ALL SELECT 'protein', CAST(l_suppkey AS VARCHAR), l_orderkey * 10 + l_linenumber FROM lineitem) GROUP BY 1, 2")
def j15_entity_rows(t):
    rows = t.lineitem.withColumn("seq", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return extract.entity_rows(rows, {"compound": "l_partkey", "protein": "l_suppkey"}, "seq")


@query("SELECT DISTINCT l_partkey AS k, CASE WHEN l_partkey % 2 = 0 THEN p_name END AS name, CASE WHEN l_partkey % 2 = 0 THEN 'full_record' ELSE 'minimal_fallback' END AS retrieval_status FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey % 7 = 0")
def j39_gap_fill(t):
    missing = t.lineitem.filter("l_partkey % 7 = 0").select(F.col("l_partkey").alias("k"))
    return extract.filled(missing, t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name")), "k")


# Profiles and audits ------------------------------------------------------------------------------------------


@query("SELECT coalesce(nullif(trim(CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE o_orderpriority END), ''), '<missing>') AS value, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM orders), 3) AS percent FROM orders GROUP BY 1")
def a13_value_counts(t):
    return quality.value_counts(t.orders.withColumn("v", F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise(F.col("o_orderpriority"))), "v")


@query("SELECT c_mktsegment, count(*) FILTER (WHERE o_orderstatus = 'F') AS \"n_F\", count(*) FILTER (WHERE o_orderstatus = 'O') AS \"n_O\", count(*) FILTER (WHERE o_orderstatus = 'P') AS \"n_P\" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def a14_cross_counts(t):
    return quality.cross_counts(t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), "c_mktsegment", "o_orderstatus", ["F", "O", "P"])


@query("""SELECT l_linestatus AS label, NULL AS split, NULL AS protein, count(*) AS n, 'all' AS level FROM lineitem GROUP BY 1 UNION ALL SELECT l_linestatus, l_returnflag, NULL, count(*), 'split' FROM lineitem GROUP BY 1, 2
UNION ALL SELECT l_linestatus, NULL, l_suppkey, count(*), 'protein' FROM lineitem GROUP BY 1, 3""")
def a23_grouping_sets(t):
    return quality.set_counts(t.lineitem, "l_linestatus", "l_returnflag", "l_suppkey")


@query("SELECT 'p_name' AS feature, count(p_name) AS n_present, count(DISTINCT p_name) AS n_distinct, true AS identifier_like, count(DISTINCT p_name) / count(p_name) AS unique_ratio, 'high' AS risk FROM part UNION ALL SELECT 'p_size', count(*), count(DISTINCT p_size), false, count(DISTINCT p_size) / count(*), CASE WHEN count(DISTINCT p_size) / count(*) >= 0.98 THEN 'high' WHEN count(DISTINCT p_size) / count(*) >= 0.9 THEN 'warning' ELSE 'low' END FROM part UNION ALL SELECT 'p_partkey', count(*), count(DISTINCT p_partkey), false, count(DISTINCT p_partkey) / count(*), 'high' FROM part")
def q20_leakage_audit(t):
    return quality.leakage_audit(t.part, ["p_name", "p_size", "p_partkey"], features.is_identifier)


@query("""SELECT source AS target, n_positive, n_negative, n_unknown, n_pairs, n_train, n_val, n_test, n_positive / nullif(n_negative, 0) AS ratio, round(100 * n_unknown / n_pairs, 3) AS percent_unknown,
  CASE WHEN n_negative < 50 OR n_positive < 100 THEN 'high_risk' WHEN round(100 * n_unknown / n_pairs, 3) > 90 OR NOT coalesce(n_positive / nullif(n_negative, 0) BETWEEN 0.1 AND 10, false) THEN 'review' ELSE 'ready' END AS risk
FROM (SELECT source, count(*) FILTER (WHERE quality = 1) AS n_positive, count(*) FILTER (WHERE quality = 0) AS n_negative, count(*) FILTER (WHERE quality IS NULL) AS n_unknown, count(*) AS n_pairs,
  count(*) FILTER (WHERE doc_id % 3 = 0 AND quality IS NOT NULL) AS n_train, count(*) FILTER (WHERE doc_id % 3 = 1 AND quality IS NOT NULL) AS n_val, count(*) FILTER (WHERE doc_id % 3 = 2 AND quality IS NOT NULL) AS n_test
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)""")
def q19_target_readiness(t):
    split = F.get(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("doc_id") % 3)
    rows = t.documents.select("doc_id", F.col("source").alias("target")).join(t.labels, "doc_id", "left").withColumn("split", split)
    return quality.target_readiness(rows, "target", "quality", "split")


@query(over_views("""SELECT rule, n, round(100 * n / total, 3) AS percent FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE endpoint_type IS NULL) AS missing_type, 0 AS missing_value, 0 AS missing_unit, 0 AS unsupported_unit, count(*) FILTER (WHERE value <= 0) AS nonpositive_value,
    count(*) FILTER (WHERE qualifier <> '=') AS one_sided_interval, count(*) FILTER (WHERE value_molar < 1e-13) AS implausibly_potent, count(*) FILTER (WHERE value_molar > 1) AS implausibly_weak,
    count(*) FILTER (WHERE NOT coalesce(comparable, false)) AS not_eligible, count(*) FILTER (WHERE label IS NULL) AS unlabelled,
    count(*) FILTER (WHERE outcome = 'inconclusive' OR (under AND outcome = 'inactive') OR (above AND outcome = 'active')) AS conflicting
  FROM labelled) UNPIVOT (n FOR rule IN (missing_type, missing_value, missing_unit, unsupported_unit, nonpositive_value, one_sided_interval, implausibly_potent, implausibly_weak, not_eligible, unlabelled, conflicting))"""))
def q22_endpoint_audit(t):
    return quality.endpoint_audit(labelled(t))


@query(over_views(PAIR_SQL + """, cand AS (SELECT protein_id, count(*) AS n_candidates FROM (SELECT p_partkey AS cid, s_suppkey AS protein_id FROM part, supplier) WHERE (cid, protein_id) NOT IN (SELECT cid, protein_id FROM evidence) GROUP BY 1),
k AS (SELECT protein_id, count(*) FILTER (WHERE label = 1) AS n_positive FROM featured GROUP BY 1)
SELECT protein_id, coalesce(n_positive, 0) AS n_positive, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_candidates, 0) / nullif(coalesce(n_positive, 0), 0) AS candidates_per_positive,
  CASE WHEN coalesce(n_positive, 0) = 0 THEN 'no_positive' WHEN coalesce(n_candidates, 0) / n_positive > 1000 THEN 'very_sparse' ELSE 'rankable' END AS status FROM k FULL JOIN cand USING (protein_id)"""))
def q24_candidate_space(t):
    return quality.rated_space(evidence.space_counts(evidence.endpoint_features(paths(t)), t.compound, t.protein))


@query(over_views(PAIR_SQL + """, cand AS (SELECT s_suppkey AS protein_id, (SELECT count(*) FROM part) - coalesce(n, 0) AS n_candidates FROM supplier LEFT JOIN (SELECT protein_id, count(DISTINCT cid) AS n FROM evidence WHERE cid IN (SELECT p_partkey FROM part) GROUP BY 1) ON protein_id = s_suppkey),
k AS (SELECT protein_id, count(*) FILTER (WHERE label = 1) AS n_positive FROM featured GROUP BY 1)
SELECT protein_id, coalesce(n_positive, 0) AS n_positive, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_candidates, 0) / nullif(coalesce(n_positive, 0), 0) AS candidates_per_positive,
  CASE WHEN coalesce(n_positive, 0) = 0 THEN 'no_positive' WHEN coalesce(n_candidates, 0) / n_positive > 1000 THEN 'very_sparse' ELSE 'rankable' END AS status FROM k FULL JOIN cand USING (protein_id)"""))
def q24_candidate_space_of_all_compounds(t):
    return q24_candidate_space(t)


@query("""WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS i, sha256('p_name=' || coalesce(length(p_name) || ':' || p_name, '~') || '|p_partkey=' || length(CAST(p_partkey AS VARCHAR)) || ':' || p_partkey || '|p_size=' || length(CAST(p_size AS VARCHAR)) || ':' || p_size) AS h FROM part),
b AS (SELECT 1 AS level, i // 64 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM r GROUP BY 2
  UNION ALL SELECT level + 1, i // 64, sha256(string_agg(h, '' ORDER BY i)) FROM b WHERE (SELECT max(i) FROM b) > 0 GROUP BY 1, 2)
SELECT (SELECT arg_max(h, level) FROM b) AS content_sha256, count(*) AS n_rows FROM r""")
def x13_table_hash(t):
    return quality.table_hash(t.part.select("p_partkey", "p_name", "p_size"), ["p_partkey"], 64)


# Markup, logs and streams -------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def x1_nested_properties(t):
    return t.events.select("event_id", F.variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


@query("SELECT p_partkey, '<http://x.example.org/c' || p_partkey || '>' AS s, '<http://x.example.org/size>' AS p, '\"' || p_size || '\"' AS o FROM part")
def s5_ntriples_text(t):
    line = F.concat(F.lit("# none\n<http://x.example.org/c"), F.col("p_partkey").cast("string"), F.lit("> <http://x.example.org/size> \""), F.col("p_size").cast("string"), F.lit("\" .\nbroken line"))
    rows = readers.ntriples_text(t.part.select(line.alias("text")), "text")
    return rows.select(F.regexp_extract("s", r"c(\d+)>", 1).cast("long").alias("p_partkey"), "s", "p", "o")


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, 'http://x.example.org/' || p_partkey AS link FROM part")
def s6_html_table(t):
    k = F.col("p_partkey").cast("string")
    html = F.concat(F.lit("<table><tr><th>Size</th><th>Link</th></tr><tr><td> <b>"), F.col("p_size").cast("string"), F.lit("</b></td><td><a href=\"http://x.example.org/"), k, F.lit("\">go</a></td></tr></table>"))
    rows = readers.html_table_rows(t.part.select("p_partkey", html.alias("html")), "html", ["p_partkey"])
    return rows.select("p_partkey", F.col("cells")["Size"].alias("size"), F.col("cells")["Link"].alias("link"))


@query("SELECT p_partkey, p_name AS name FROM part")
def s7_sparql_bindings(t):
    value = lambda c: F.struct(F.lit("literal").alias("type"), c.cast("string").alias("value"))
    row = F.create_map(F.lit("Key"), value(F.col("p_partkey")), F.lit("NAME"), value(F.col("p_name")))
    text = F.to_json(F.struct(F.struct(F.array(row).alias("bindings")).alias("results")))
    found = readers.sparql_rows(t.part.select(text.alias("text")), "text")
    return found.select(F.col("row")["key"].cast("long").alias("p_partkey"), F.col("row")["name"].alias("name"))


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS text FROM conversations")
def k4_flattened(t):
    return writers.flattened(t.conversations.select("conv_id", "turn", "text"), ["conv_id"])


def _scratch(t: Tables) -> str:
    base = t.spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not t.spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="evigraph-", dir="/tmp")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event_stream(t: Tables) -> DataFrame:
    return t.spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(t.folder)


def drained(t: Tables, rows: DataFrame) -> DataFrame:
    """All that a stream gives for what is there now, written and read back."""
    path = _scratch(t)
    started = rows.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    started.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(f"{path}/out")


@query("SELECT DISTINCT user_id, event_type FROM events")
def v2_first_occurrence_stream(t):
    return drained(t, jobs.first_occurrences(event_stream(t).select("user_id", "event_type"), ["user_id", "event_type"]))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k <= 3")
def v4_capped_stream(t):
    return drained(t, jobs.capped_stream(event_stream(t).select("user_id", "event_id"), "user_id", "event_id", 3))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def v3_keyed_upsert_stream(t):
    path = _scratch(t)
    rows = event_stream(t).select("user_id", "event_type", "event_id")
    started = jobs.upsert_each_batch(rows, ["user_id"], "event_id", f"{path}/table", f"{path}/state").trigger(availableNow=True).start()
    started.awaitTermination()
    return tables.KeyedTable(t.spark, f"{path}/table", ["user_id"], "event_id").read().select("user_id", "event_type", "event_id")


@query("""SELECT * FROM (SELECT 'nodes' AS part, 'User' AS kind, count(DISTINCT user_id) AS n FROM events UNION ALL SELECT 'nodes', 'Event', count(*) FROM events UNION ALL SELECT 'nodes', 'EventType', count(DISTINCT event_type) FROM events
UNION ALL SELECT 'edges', 'DID', count(*) FROM events UNION ALL SELECT 'edges', 'HAS_TYPE', count(*) FROM events UNION ALL SELECT 'edges', 'DOES', count(*) FROM (SELECT DISTINCT user_id, event_type FROM events))""")
def v1_graph_stream(t):
    """Nodes and edges of all events, appended batch by batch."""
    path = _scratch(t)
    started = tables.graph_each_batch(event_stream(t), event_nodes, event_edges, f"{path}/graph", f"{path}/state").trigger(availableNow=True).start()
    started.awaitTermination()
    log = tables.BatchLog(t.spark, f"{path}/graph")
    nodes = log.read("nodes").groupBy(F.lit("nodes").alias("part"), F.col("label").alias("kind")).agg(F.count("*").alias("n"))
    return nodes.unionByName(log.read("edges").groupBy(F.lit("edges").alias("part"), F.col("type").alias("kind")).agg(F.count("*").alias("n")))


def event_nodes(rows: DataFrame) -> DataFrame:
    made = F.array(*(F.struct(F.lit(label).alias("label"), X.node_ref(label, id=key).alias("node_ref")) for label, key in (("User", "user_id"), ("Event", "event_id"), ("EventType", "event_type"))))
    return rows.select(F.explode(made).alias("_n"), F.col("event_id").alias("seq")).select("_n.label", "_n.node_ref", "seq")


def event_edges(rows: DataFrame) -> DataFrame:
    ends = {name: X.node_ref(label, id=key) for name, label, key in (("user", "User", "user_id"), ("event", "Event", "event_id"), ("type", "EventType", "event_type"))}
    made = F.array(*(F.struct(F.lit(kind).alias("type"), ends[a].alias("start_ref"), ends[b].alias("end_ref")) for kind, a, b in (("DID", "user", "event"), ("HAS_TYPE", "event", "type"), ("DOES", "user", "type"))))
    return rows.select(F.explode(made).alias("_e"), F.col("event_id").alias("seq")).select("_e.type", "_e.start_ref", "_e.end_ref", "seq")


@query("""WITH rows AS (SELECT 1 AS s, row_number() OVER (ORDER BY p_partkey) - 1 AS i, sha256('cid=' || length(CAST(p_partkey AS VARCHAR)) || ':' || p_partkey || '|size=' || length(CAST(p_size AS VARCHAR)) || ':' || p_size) AS h FROM part
UNION ALL SELECT 2, row_number() OVER (ORDER BY p_size) - 1, sha256('n=' || length(CAST(count(*) AS VARCHAR)) || ':' || count(*) || '|size=' || length(CAST(p_size AS VARCHAR)) || ':' || p_size) FROM part GROUP BY p_size),
b AS (SELECT s, i // 4096 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, count(*) AS n FROM rows GROUP BY 1, 2)
SELECT CASE s WHEN 1 THEN 'compounds' ELSE 'sizes' END AS stage, CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS content_sha256, CAST(sum(n) AS BIGINT) AS n_rows, 'complete' AS status, CASE s WHEN 1 THEN 'part' ELSE 'compounds' END AS made_from FROM b GROUP BY s""")
def q28_stage_lineage(t):
    """Two stages, then the run again, which reads both."""
    folder = _scratch(t)
    for mode in (stages.REFUSE, stages.RESUME):
        run = stages.Run(t.spark, folder, mode)
        run.stage("compounds", lambda part: part.select(F.col("p_partkey").alias("cid"), F.col("p_size").alias("size")), ["cid"], {"part": t.part.select("p_partkey", "p_size")})
        run.stage("sizes", lambda compounds: compounds.groupBy("size").agg(F.count("*").alias("n")), ["size"], after=["compounds"])
    return run.lineage().select("stage", "status", "n_rows", "content_sha256", "made_from")


# More profiles -----------------------------------------------------------------------------------------------


@query("SELECT l_suppkey AS k, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'A') AS \"n_A\", count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'N') AS \"n_N\" FROM lineitem GROUP BY 1")
def a10_annotation_sets(t):
    found = quality.annotation_sets(t.lineitem.withColumn("k", F.col("l_suppkey")), "k", "l_returnflag", "l_partkey", ["A", "N"])
    return found.select("k", "n_A", "n_N")


@query("SELECT c_mktsegment AS kind, count(*) AS n, avg(d) AS mean, median(d) AS median, max(d) AS max FROM (SELECT o_custkey, count(*) AS d FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def a16_degree_by_type(t):
    degree = t.orders.groupBy("o_custkey").agg(F.count("*").alias("d")).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return degree.groupBy(F.col("c_mktsegment").alias("kind")).agg(F.count("*").alias("n"), F.avg("d").alias("mean"), F.median("d").alias("median"), F.max("d").alias("max"))


@query(over_views(PAIR_SQL + "SELECT label, round(avg(n_ic50), 6) AS mean_ic50, round(avg(coalesce(min_value_um, 0)), 3) AS mean_um FROM featured GROUP BY 1"))
def a18_mean_by_label(t):
    found = evidence.endpoint_features(paths(t))
    return found.groupBy("label").agg(F.round(F.avg("n_ic50"), 6).alias("mean_ic50"), F.round(F.avg(F.coalesce("min_value_um", F.lit(0.0))), 3).alias("mean_um"))


@query("SELECT 'o_orderpriority' AS \"column\", avg(CAST(o_orderkey % 9 = 0 AS INTEGER)) AS missing_fraction FROM orders UNION ALL SELECT 'o_custkey', avg(CAST(o_orderkey % 5 = 0 AS INTEGER)) FROM orders")
def a19_missing_fractions(t):
    rows = t.orders.select(F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"))
    return quality.missing_fractions(rows, ["o_orderpriority", "o_custkey"])


@query("SELECT avg(CAST(o_orderkey % 9 <> 0 OR o_orderkey % 5 <> 0 AS INTEGER)) AS covered FROM orders")
def a24_alias_coverage(t):
    rows = t.orders.select(F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise("x").alias("a"), F.when(F.col("o_orderkey") % 5 != 0, F.lit(1)).alias("b"))
    return rows.agg(F.avg(features.any_present("a", "b").cast("int")).alias("covered"))


@query(over_views("""SELECT count(*) AS n_edges, count(*) FILTER (WHERE a % 20 <> 0 AND b % 20 <> 0) AS n_valid, count(*) FILTER (WHERE a % 20 = 0 OR b % 20 = 0) AS n_dangling,
  (SELECT count(DISTINCT x) FROM (SELECT a AS x FROM similar_to UNION SELECT b FROM similar_to) WHERE x % 20 = 0) AS n_missing_ids,
  (SELECT count(DISTINCT x) FROM (SELECT a AS x FROM similar_to UNION SELECT b FROM similar_to) WHERE x % 20 <> 0 AND x % 3 <> 0) AS n_similarity_only FROM similar_to"""))
def a26_similarity_quality(t):
    nodes = t.compound.select(F.col("cid").alias("id")).filter("id % 20 != 0")
    return quality.similarity_quality(t.similar_to, nodes, nodes.filter("id % 3 = 0"))


@query("SELECT 'suppliers' AS layer, count(*) AS n_rows, 'materialized' AS status FROM supplier UNION ALL SELECT 'none', 0, 'requested_but_empty' UNION ALL SELECT 'left', 0, 'not_requested'")
def a28_layer_status(t):
    return quality.layer_status({"suppliers": t.supplier, "none": t.supplier.filter("s_suppkey < 0"), "left": t.part.filter("p_partkey < 0")}, ["suppliers", "none"])


@query("SELECT lang, length(text) AS n_chars, count(*) AS n FROM documents GROUP BY 1, 2")
def a31_text_lengths(t):
    return t.documents.groupBy("lang", F.length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("n"))


@query(over_views("SELECT DISTINCT x.cid, x.protein_id FROM evidence x JOIN (SELECT l_partkey AS cid, l_suppkey AS protein_id FROM lineitem WHERE l_discount > 0.08) v USING (cid, protein_id)"))
def j24_validated_pairs(t):
    records = t.lineitem.filter("l_discount > 0.08").select(F.col("l_partkey").alias("cid"), F.col("l_suppkey").alias("protein_id"))
    # Which pairs have a measurement doesn't depend on what was measured, so only ends of the paths are joined.
    pairs = evidence.evidence_paths(t.endpoint.select("mg_id", "sid"), t.substance, t.tested_on).select("cid", "protein_id")
    return pairs.distinct().join(records.distinct(), ["cid", "protein_id"], "left_semi")


@query(over_views("SELECT DISTINCT b AS cid FROM similar_to WHERE b % 4 = 0"))
def j33_missing_neighbours(t):
    known = t.compound.filter("cid % 4 != 0")
    return t.similar_to.select(F.col("b").alias("cid")).distinct().join(known, "cid", "left_anti")


@query("SELECT p_brand AS relation, dense_rank() OVER (ORDER BY p_brand) - 1 AS relation_id FROM (SELECT DISTINCT p_brand FROM part)")
def ow8_relation_ids(t):
    return graph.dense_ids(t.part.select(F.col("p_brand").alias("relation")).distinct(), ["relation"], "relation_id")


@query(over_views(PAIR_SQL + "SELECT cid, protein_id, label, CASE WHEN label = 0 THEN 'weak_or_declared_inactive_measurement' END AS negative_source FROM featured WHERE label IS NOT NULL"))
def u3_training_pairs(t):
    return evidence.training_pairs(evidence.endpoint_features(paths(t))).select("cid", "protein_id", "label", "negative_source")


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'unknown' WHEN 3 THEN 'other' ELSE 'positive' END AS name FROM orders")
def l5_label_names(t):
    form = F.get(F.array(F.lit("1"), F.lit(" Inactive"), F.lit(None), F.lit("x"), F.lit("True")), F.col("o_orderkey") % 5)
    return t.orders.select("o_orderkey", quality.label_name(form).alias("name"))

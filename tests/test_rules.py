"""Measurement rules, labels and identifiers on small tables of cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from evigraph.functions import endpoint as E
from evigraph.functions import targets as T
from evigraph.functions import text as X
from evigraph.operators import components, evidence, features, graph, similarity
from evigraph.operators.extract import known_or_missing

SCHEMA = "endpoint_type string, value string, unit string, qualifier string, outcome string"


def measured(spark, *rows, tau=None, weak=False):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, " + SCHEMA)
    return E.with_label(E.with_normalized_endpoint(df), tau, weak).orderBy("i").collect()


@pytest.mark.parametrize("kind", ["IC50", "Ki", "Kd", "EC50", "AC50"])
def test_plain_concentration(spark, kind):
    (r,) = measured(spark, (kind, "10", "uM", None, None))
    assert r.value_molar == pytest.approx(1e-5) and r.potency_value == pytest.approx(5.0)
    assert r.threshold_label_eligible and r.potency_scale_name == f"p{kind}"


def test_log_scale(spark):
    r, above, span, zero = measured(spark, ("PubChem_pKi_endpoint", "7", None, None, None), ("pKi", "6", None, ">", None), ("pIC50", "5-7", None, None, None), ("pIC50", "0", None, None, None))
    assert (r.endpoint_type, r.reported_scale) == ("Ki", "negative_log10_molar")
    assert r.value_molar == pytest.approx(1e-7) and r.potency_value == pytest.approx(7.0)
    assert above.value_upper_molar == pytest.approx(1e-6) and not above.value_upper_inclusive and above.value_lower_molar is None
    assert span.value_lower_molar == pytest.approx(1e-7) and span.value_upper_molar == pytest.approx(1e-5)
    assert span.normalization_status == "normalized_log_molar_range" and span.threshold_label_eligible
    assert zero.normalization_status == "invalid_log_potency_value"


@pytest.mark.parametrize(("sign", "side", "closed"), [("<", "upper", False), ("<=", "upper", True), (">", "lower", False), (">=", "lower", True)])
def test_bounds(spark, sign, side, closed):
    (r,) = measured(spark, ("IC50", "10", "uM", sign, None))
    other = "lower" if side == "upper" else "upper"
    assert r[f"value_{side}_molar"] == pytest.approx(1e-5) and r[f"value_{side}_inclusive"] is closed
    assert r[f"value_{other}_molar"] is None


def test_labels(spark):
    rows = measured(spark, ("AC50", "5-20", "uM", None, None), ("Kd", "5", "uM", None, None), ("Kd", "10", "uM", ">=", None), ("Kd", "10", "uM", ">", None), ("Kd", "10", "uM", "<", None), ("IC50", "1", "uM", None, "inactive"), ("IC50", "5", "mg/L", None, None), ("Ki", "0", "uM", None, None), ("Km", "1", "uM", None, None), tau=10.0, weak=True)
    assert [r.label for r in rows] == [None, 1, None, 0, 1, None, None, None, None]
    assert rows[0].label_reason == "measurement_interval_crosses_activity_threshold"
    assert rows[5].label_reliability == "conflicting"
    assert [r.normalization_status for r in rows[6:8]] == ["unsupported_unit", "nonpositive_value"]
    assert not rows[8].threshold_label_eligible


def test_labels_without_threshold(spark):
    active, number = measured(spark, (None, None, None, None, "active"), ("IC50", "5", "uM", None, None))
    assert (active.label, active.label_basis, active.label_reliability) == (1, "source_activity_outcome", "source_asserted")
    assert number.label is None


def test_stored_label_only_without_threshold(spark):
    df = E.with_normalized_endpoint(spark.createDataFrame([("IC50", "50", "uM", None, None)], SCHEMA)).withColumn("stored", F.lit("1"))
    assert E.with_label(df, None, stored="stored").first().label == 1
    assert E.with_label(df, 10.0, True, stored="stored").first().label == 0


def test_targets(spark):
    row = spark.range(1).select(
        T.accession(F.lit("protein:ACCP10635")).alias("a"), T.accession(F.lit("P08684-2")).alias("b"), T.cyp_symbol(F.lit("1565")).alias("c"),
        T.cyp_symbol(F.lit("Cytochrome P450 family 3 subfamily A member 4")).alias("d"), T.cyp_symbol(F.lit("kinase"), F.lit("CYP 2D6")).alias("e"), X.relationship_type(F.lit("has part\\n(old)/new")).alias("f"),
    ).first()
    assert tuple(row) == ("P10635", "P08684", "CYP2D6", "CYP3A4", "CYP2D6", "HAS_PART_NEW")


def test_weighted_score(spark):
    rows = spark.createDataFrame([(2244, "P1", 1, 2.0, "ep1"), (2244, "P1", 0, 1.0, "ep2"), (2244, "P2", 1, 1.0, None)], "cid long, protein_id string, activity int, w double, endpoint_id string")
    (r,) = evidence.weighted_scores(rows, 2).collect()
    assert r.score == pytest.approx(2 / 3) and r.evidence == ["ep1", "ep2"]


def test_train_only_statistics(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 101.0)], "node long, descriptor double")
    found = {r.node: r.x_descriptor for r in features.model_matrix(rows, ["node"], rows.filter("node < 3")).collect()}
    assert found == {1: -1.0, 2: 1.0, 3: 99.0}


def test_merge_keeps_values(spark):
    rows = spark.createDataFrame([("a", 1, "x", ["p"], {"k": "1"}), ("a", 2, " ", ["q", "p"], {"k": "2", "m": None}), ("a", 3, None, [], {})], "id string, seq int, name string, tags array<string>, props map<string,string>")
    (r,) = graph.merged(rows, ["id"], "seq").collect()
    assert (r["name"], r.tags, r.props["k"]) == ("x", ["p", "q"], "2")
    again = graph.merged(graph.merged(rows, ["id"], "seq").withColumn("seq", F.lit(1)), ["id"], "seq")
    assert again.first().tags == ["p", "q"]


def test_components_long_chain_and_singleton(spark):
    nodes = spark.range(60).select(F.col("id").alias("node"))
    edges = spark.range(49).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = {r.node: r.component for r in components.connected_components(nodes, edges).collect()}
    assert all(found[i] == 0 for i in range(50)) and all(found[i] == i for i in range(50, 60))
    splits = components.component_split(spark.createDataFrame(list(found.items()), "node long, component long"))
    assert splits.groupBy("component").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()


def test_empty_inputs(spark):
    edges = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(spark.createDataFrame([], "node long"), edges).count() == 0
    assert similarity.neighbours(spark.createDataFrame([], "id long, bits array<int>"), 0.8, 5).count() == 0
    rows = spark.createDataFrame([(1, None), (2, 9), (3, 5)], "i int, k int")
    assert [r.i for r in known_or_missing(rows, "k", spark.createDataFrame([(5,)], "k int")).orderBy("i").collect()] == [1, 3]


def test_matrix_has_no_identifiers_or_nan(spark):
    rows = spark.createDataFrame([("a", "id1", "1.5", None), ("b", "id2", None, 2.0)], "node string, other_id string, x string, y double")
    found = features.model_matrix(rows, ["node"])
    assert set(found.columns) == {"node", "x_x", "missing_x", "x_y", "missing_y"}
    assert all(not math.isnan(v) for r in found.collect() for v in r[1:])


def test_candidate_counts_are_those_of_the_product(spark):
    from evigraph.operators import evidence

    compounds = spark.createDataFrame([(k,) for k in [*range(1, 45), 7]], "cid long")
    proteins = spark.createDataFrame([(k,) for k in (1, 2, 3, 3)], "protein_id long")
    seen = spark.createDataFrame([(1, 1), (1, 1), (20, 1), (99, 2), *((k, 3) for k in range(1, 45))], "cid long, protein_id long")
    pairs = evidence.candidate_pairs(compounds, proteins, seen).groupBy("protein_id").count().collect()
    found = {r.protein_id: r.n_candidates for r in evidence.candidate_counts(compounds, proteins, seen).collect()}
    assert found == {r["protein_id"]: r["count"] for r in pairs} == {1: 42, 2: 44}

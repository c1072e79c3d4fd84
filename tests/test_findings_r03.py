"""What the third round's findings asked for: each of these failed before."""

from __future__ import annotations

import os

import duckdb
from pyspark.sql import functions as F

from evigraph.functions import endpoint as E
from evigraph.functions import nodes as N
from evigraph.operators import evidence, extract, modeling, records
from evigraph.registry import ORACLES, QUERIES
from evigraph.streaming import jobs

from .conftest import SF, TABLES, same_as_sql


def scaled(tmp_path, **selects):
    """A folder with the smallest tables, some of them replaced by a SELECT over them, and a DuckDB connection to it."""
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{tmp_path}/{table}.parquet"
        if table in selects:
            connection.execute(f"COPY ({selects[table].format(table=f'{SF}/{table}.parquet')}) TO '{path}'")
        else:
            os.symlink(f"{SF}/{table}.parquet", path)
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return str(tmp_path), connection


def agrees(spark, folder, connection, name):
    same_as_sql(spark, connection, lambda s, _: QUERIES[name](s, folder), ORACLES[name])


def test_plans_of_normalized_properties_stay_small(spark):
    """Each value stands in the plan once; copies of copies took Spark minutes to plan and were evaluated for every entry."""
    nodes = spark.createDataFrame([("Reference", "Reference|reference_id=PMID:7", {"title": "A study of 1999"})], "label string, node_ref string, props map<string,string>")
    found = N.with_normalized_props(nodes)
    assert len(found._jdf.queryExecution().analyzed().toString()) < 100_000
    props = found.first().props
    assert props["pmid"] == "7" and props["year"] == "1999" and props["url"].endswith("/7/") and "doi" not in props


def test_symbols_of_many_suppliers(spark, tmp_path):
    """Supplier keys that are accessions or gene ids of known enzymes."""
    folder, connection = scaled(tmp_path, supplier="SELECT * REPLACE (k AS s_suppkey) FROM (SELECT *, unnest([5177, 8684, 10635, 1544, 1576, 29785, 113612, 7]) AS k FROM '{table}' LIMIT 8)")
    agrees(spark, folder, connection, "s12_protein_records")
    agrees(spark, folder, connection, "t1_normalized_proteins")


def test_table_hash_of_four_levels(spark, tmp_path):
    folder, connection = scaled(tmp_path, part="SELECT * REPLACE (p_partkey + 100000 * i AS p_partkey) FROM '{table}', range(1400) r(i)")
    assert connection.sql("SELECT count(*) FROM part").fetchall()[0][0] > 64**3
    agrees(spark, folder, connection, "x13_table_hash")


def test_values_at_the_threshold(spark):
    """10 uM in any unit is at the threshold of 10 uM."""
    rows = [("a", 10000.0, "nM", "="), ("b", 10.0, "uM", "="), ("c", 10000.0, "nM", ">"), ("d", 10.0, "uM", ">"), ("e", 1e7, "pM", "<"), ("f", 10000.01, "nM", "=")]
    found = spark.createDataFrame([(i, "IC50", v, u, q) for i, v, u, q in rows], "endpoint_id string, endpoint_type string, value double, unit string, qualifier string")
    labels = {r.endpoint_id: r.label for r in E.with_label(E.with_normalized_endpoint(found), 10.0, True).collect()}
    assert labels == {"a": 1, "b": 1, "c": 0, "d": 0, "e": 1, "f": 0}


def test_pair_labels_at_the_threshold(spark, tmp_path):
    folder, connection = scaled(tmp_path, lineitem="SELECT * REPLACE (10000.0 AS l_extendedprice, 'N' AS l_returnflag) FROM '{table}'")
    for name in ("l1_label_decisions", "a5_pair_features", "l4_pair_labels", "u3_training_pairs", "q10_endpoint_analysis", "q24_candidate_space_of_all_compounds"):
        agrees(spark, folder, connection, name)


def test_capped_stream_of_several_frames(spark, tmp_path):
    """A key's rows come in frames of two, largest first."""
    spark.range(10).select(F.lit(1).cast("long").alias("user_id"), (-F.col("id")).alias("event_id")).coalesce(1).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        rows = jobs.capped_stream(jobs.log_stream(spark, f"{tmp_path}/in", "user_id long, event_id long"), "user_id", "event_id", 3)
        started = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        started.awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [-9, -8, -7]


def test_candidates_are_not_shuffled(spark):
    """The product of compounds and proteins is neither exchanged nor sorted; blocks of proteins give the same pairs."""
    compounds, proteins = spark.range(30).withColumnRenamed("id", "cid"), spark.range(20).withColumnRenamed("id", "protein_id")
    observed = compounds.crossJoin(proteins).filter("(cid + protein_id) % 3 = 0")
    for size in (100, 7):
        found = evidence.candidate_pairs(compounds, proteins, observed, size)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan and "Cross" in plan
        assert found.count() == found.distinct().count() == 600 - observed.count()
        assert found.join(observed, ["cid", "protein_id"], "left_semi").count() == 0
    counts = modeling.candidate_counts_of_observed(compounds, proteins, observed)
    slow = modeling.candidates_of_observed(evidence.candidate_pairs(compounds, proteins, observed), observed).groupBy("cid").count()
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, slow.collect()))


def test_sampled_of_many_is_sampled(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    for n in (0, 1, 700, 4999, 9000):
        for total in (5000, 500_000):
            found = evidence.sampled_of_many(rows, ["k"], n, total, per_block=100)
            assert sorted(found.collect()) == sorted(evidence.sampled(rows, ["k"], n).collect())


def test_molecules_are_capped_before_the_join(spark):
    """Every compound and molecule shares one key."""
    compounds = spark.range(3000).select(F.col("id").alias("cid"), F.lit("K").alias("inchikey"))
    molecules = spark.range(3000).select(F.lit("K").alias("inchikey"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("chembl_id"))
    found = records.molecules_by_key(compounds, molecules, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter (_k#") >= 2
    assert {r.chembl_id for r in found.collect()} == {"C0", "C1", "C10"} and found.count() == 9000


def test_interaction_support_does_not_expand(spark):
    """Distinct counts without a copy of each row for each of them; nulls count as none."""
    rows = [(1, 1, "a", 1, 1, 1), (1, 1, "a", 2, None, 1), (1, 1, "b", 2, 5, 0), (1, 2, None, None, None, None), (2, 1, "c", 7, 7, None)]
    paths = spark.createDataFrame(rows, "cid long, protein_id long, endpoint_id string, mg_id long, sid long, label int")
    references = spark.createDataFrame([("a", "r1"), ("a", "r2"), ("b", "r2")], "endpoint_id string, reference_id string")
    found = evidence.interaction_support(paths, references)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.cid, r.protein_id): tuple(r[2:9]) for r in found.select("cid", "protein_id", "n_endpoints", "n_groups", "n_substances", "n_positive", "n_negative", "n_unclear", "n_references").collect()}
    assert got == {(1, 1): (2, 2, 2, 4, 1, 0, 2), (1, 2): (0, 0, 0, 0, 0, 1, 0), (2, 1): (1, 1, 1, 0, 0, 1, 0)}


def test_rows_without_a_key_are_not_joined(spark):
    """Most rows have no key; an outer join hashes them all to one partition."""
    rows = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), "id")
    found = extract.known_or_missing(rows, "k", spark.range(0, 500).withColumnRenamed("id", "k"))
    assert "LeftOuter" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.columns == ["k", "id"] and found.filter("k is null").count() == 900 and found.filter("k is not null").count() == 50

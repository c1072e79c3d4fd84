"""What the fourth round's findings asked for: each of these failed before."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from evigraph.operators import cooccurrence, evidence, extract, graph, modeling, quality, scopes
from evigraph.registry import ORACLES, QUERIES

from .conftest import SF
from .test_findings_r03 import agrees, scaled


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def odd_measurements(spark):
    """Measurements, some with shared ids, substances of several compounds, groups of several proteins, references; nulls in all."""
    dice = random.Random(5)
    pick = lambda n: dice.choice([None, *range(n)])
    ends = [(dice.choice([None, "a", "b", *(f"e{k}" for k in range(40))]), pick(9), pick(12), dice.choice([None, "Ki", "Kd"]), dice.choice([1e-6, 2e-6, None]), dice.choice([None, 0, 1])) for _ in range(150)]
    endpoints = spark.createDataFrame(ends * 2, "endpoint_id string, mg_id long, sid long, endpoint_type string, value_molar double, label int")
    substances = spark.createDataFrame(sorted({(dice.randrange(12), dice.randrange(5)) for _ in range(20)}), "sid long, cid long")
    tested = spark.createDataFrame([(pick(9), pick(6)) for _ in range(40)], "mg_id long, protein_id long")
    references = spark.createDataFrame([(dice.choice([None, "a", "e1", *(f"e{k}" for k in range(20))]), dice.choice([None, "r1", "r2", "r3"])) for _ in range(60)], "endpoint_id string, reference_id string")
    return endpoints, substances, tested, references


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_paths_by_compound_are_evidence_paths(spark):
    endpoints, substances, tested, references = odd_measurements(spark)
    slow = evidence.evidence_paths(endpoints, substances, tested.distinct())
    for size in (100_000, 7):
        fast = evidence.paths_by_compound(endpoints, substances, tested, size)
        assert rows(fast.select(*slow.columns)) == rows(slow)
        support = evidence.interaction_support_by_compound(endpoints, substances, tested, references, size)
        assert rows(support) == rows(evidence.interaction_support(slow, references).select(*support.columns))
    assert ", 43), REPARTITION_BY_NUM" in plan_of(fast)


@pytest.mark.parametrize("name", ["a4_interaction_support", "a5_pair_features", "q24_candidate_space_of_all_compounds", "j35_candidate_pairs"])
def test_paths_fan_out_after_the_last_shuffle(spark, name):
    """Paths were shuffled, which are several times the measurements, and measurements by their words."""
    plan = plan_of(QUERIES[name](spark, SF))
    pairs = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "protein_id" in line.split("hashpartitioning(")[1].split(")")[0]]
    assert all("hashpartitioning(protein_id" in line for line in pairs) and "hashpartitioning(coalesce(endpoint_type" not in plan


def test_measurements_that_differ_in_their_reason_only(spark, tmp_path):
    """Why a measurement has its label is not measured: measurements that differ in nothing else were two."""
    twice = "SELECT * REPLACE (CASE WHEN i = 0 THEN 1 ELSE 45 END AS l_quantity, 1.0 AS l_extendedprice, 0.09 AS l_discount) FROM '{table}', range(2) r(i)"
    folder, connection = scaled(tmp_path, lineitem=twice.replace("* REPLACE", "* EXCLUDE (i) REPLACE"))
    agrees(spark, folder, connection, "a5_pair_features")


def test_candidate_space_has_all_compounds(spark):
    """Only every twentieth compound was read."""
    assert "% 20" not in ORACLES["q24_candidate_space"]
    assert rows(QUERIES["q24_candidate_space"](spark, SF)) == rows(QUERIES["q24_candidate_space_of_all_compounds"](spark, SF))
    pairs = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (9, 1, 1), (1, 2, None), (1, None, 1), (2, 8, 1)], "cid long, protein_id long, label int")
    compounds, proteins = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "cid long"), spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "protein_id long")
    counts = evidence.space_counts(pairs, compounds, proteins)
    slow = quality.candidate_space(pairs, evidence.candidate_counts(compounds, proteins, pairs), "protein_id")
    assert rows(quality.rated_space(counts)) == rows(slow.select("protein_id", "n_positive", "n_candidates", "candidates_per_positive", "status"))


def test_cooccurrences_are_all_there(spark):
    """The query kept 250 rows of a target and two references of a pair, and all rows were shuffled to be told apart."""
    assert "<= 250" not in ORACLES["g10_cooccurrences"] and "<= 2)" not in ORACLES["g10_cooccurrences"]
    dice = random.Random(4)
    kinds = ("compound", "protein", "gene", "disease", "reference")
    terms = [f"{kind}:{k}" for kind in kinds for k in range(4)]
    triples = [(f"cooccurrence:{dice.randrange(40)}", f"x:{dice.randrange(3)}", dice.choice(terms)) for _ in range(260)] + [(dice.choice(terms), "x:in", f"cooccurrence:{dice.randrange(60)}") for _ in range(120)]
    triples = spark.createDataFrame(triples * 2 + [("cooccurrence:1", "y#score", "0.5")], "s string, p string, o string")
    targets = spark.createDataFrame([(x,) for x in (*terms[:14], None, "protein:0")], "target string")
    listed = spark.createDataFrame([("compound:1",), ("compound:2",)], "compound string")
    for compounds in (None, listed):
        found = cooccurrence.cooccurrences(triples, targets, compounds)
        slow = cooccurrence.cooccurrences(triples, targets, compounds, per_target=1_000_000)
        assert rows(found) == rows(slow.select(*found.columns)) and found.count() > 100
        assert "Window" not in plan_of(found)


def test_evidence_of_both_lists_is_whole(spark):
    """The query kept 40 groups of a target."""
    assert "<= 40" not in ORACLES["j18_evidence_of_both"]
    P = extract.PREDICATES
    triples = [t for k in range(90) for t in ((f"mg:{k}", P["participant"], "protein:1"), (f"mg:{k}", P["output"], f"endpoint:{k}"), (f"endpoint:{k}", P["about"], f"sid:{k % 7}"), (f"aid:{k % 5}", P["assay_group"], f"mg:{k}"))]
    triples += [(f"sid:{k}", P["standardized"], f"cid:{k % 2}") for k in range(7)]
    triples = spark.createDataFrame(triples * 2, "s string, p string, o string")
    compounds, seeds = spark.createDataFrame([("cid:1",)], "compound string"), spark.createDataFrame([("protein", "1")], "kind string, id string")
    found = scopes.intersection(compounds, seeds, triples).select("mg", "endpoint", "substance", "compound", "protein", "assay")
    wanted = [(f"mg:{k}", f"endpoint:{k}", f"sid:{k % 7}", "cid:1", "protein:1", f"aid:{k % 5}") for k in range(90) if k % 7 % 2 == 1]
    assert rows(found) == sorted(wanted, key=repr)
    capped = scopes.intersection(compounds, seeds, triples, per_target=5, per_group=1)
    assert sorted(r.mg for r in capped.collect()) == sorted(r[0] for r in wanted)[:5]
    assert 0 < QUERIES["j18_evidence_of_both"](spark, SF).count()


@pytest.mark.parametrize("name", ["j14_participating_proteins", "j16_evidence_from_targets", "j17_evidence_from_compounds", "j18_evidence_of_both"])
def test_nothing_is_made_after_genes_fan_out(spark, name):
    """Ids were cut out of their terms in each of the rows that grow with the square of the tables."""
    plan = plan_of(QUERIES[name](spark, SF))
    lines = plan.splitlines()
    union = next(k for k, line in enumerate(lines) if "Union" in line)
    last = max(k for k, line in enumerate(lines) if line.find("+- ") == lines[union].index("Union"))
    place = next(k for k, line in enumerate(lines) if k >= last and "BroadcastHashJoin [target" in line)
    depth, above = lines[place].index("BroadcastHashJoin"), []
    for line in reversed(lines[:place]):
        inset = len(line) - len(line.lstrip(" :+-"))
        if inset < depth:
            depth = inset
            above.append(line)
    assert "substring_index" in plan and not any("substring_index" in line or "Exchange" in line for line in above)


def test_rows_of_a_group_follow_each_other(spark):
    """Genes were mixed in a task, so files of their rows were as large as their number."""
    made = spark.range(4000).select(F.col("id").alias("mg"), (F.xxhash64("id") % 5).alias("gene"), F.lit(None).cast("array<long>").alias("_named"))
    links = spark.range(50).select((F.xxhash64(F.col("id") + 99) % 5).alias("gene"), F.col("id").alias("protein"))
    for size in (100_000, 20):
        found = graph.fanned_out(made, links, "gene", "protein", "_named", size)
        assert rows(found.select("mg", "protein")) == rows(made.join(links, "gene").select("mg", "protein"))
    found = graph.fanned_out(made, links, "gene", "protein", "_named").withColumn("part", F.spark_partition_id()).collect()
    runs = sum(1 for a, b in zip(found, found[1:]) if (a.part, a.gene) != (b.part, b.gene)) + 1
    assert runs == len({(r.part, r.gene) for r in found}) > 4


def test_pairs_come_in_runs_of_proteins(spark):
    """All proteins of a compound followed each other, so the same ids came again too far away for a file to tell."""
    compounds = spark.createDataFrame([(k,) for k in (*range(40), 3, None)], "cid long")
    proteins = spark.createDataFrame([(k,) for k in (*range(900), 5, None)], "protein_id long")
    observed = spark.createDataFrame([(k, k * j) for k in range(40) for j in range(12)] + [(None, 1), (1, None)], "cid long, protein_id long")
    known = {(k, k * j) for k in range(40) for j in range(12)}
    wanted = sorted(((c, p) for c in (*range(40), None) for p in (*range(900), None) if (c, p) not in known), key=repr)
    for size in (100_000, 70):
        assert rows(evidence.candidate_pairs(compounds, proteins, observed, size)) == wanted
    found = evidence.candidate_pairs(compounds, proteins, observed).withColumn("part", F.spark_partition_id()).collect()
    (part,) = {r.part for r in found if r.cid == 7}
    mine = [r for r in found if r.part == part]
    assert len({r.cid for r in mine[:600]}) > 1 and max(map(len, runs_of(mine))) < 400


def runs_of(found):
    out = [[found[0]]]
    for a, b in zip(found, found[1:]):
        out.append([b]) if a.cid != b.cid else out[-1].append(b)
    return out


def test_pairs_are_hashed_before_observed_ones_go(spark):
    """Numbers were made of all hashes, texts of both ids for each pair, and each was looked for among the observed ones."""
    compounds = spark.createDataFrame([(k,) for k in (*range(50), 3)], "cid long")
    proteins = spark.createDataFrame([(k,) for k in range(300)], "protein_id long")
    observed = spark.createDataFrame([(k % 50, k * 7 % 300) for k in range(4000)] + [(None, 1)], "cid long, protein_id long")
    slow = evidence.candidate_pairs(compounds, proteins, observed)
    for positives, n in ((0, 1000), (200, 2000), (9000, slow.count())):
        found = modeling.candidates(compounds, proteins, observed, positives, mode="hash_order").select("cid", "protein_id")
        assert rows(found) == rows(evidence.sampled(slow, ["cid", "protein_id"], n))
    every, hashed = evidence.hashed_pairs(compounds, proteins)
    assert every.filter(hashed != evidence.hash_order(["cid", "protein_id"], 13)).count() == 0
    assert "array_contains" not in plan_of(every) and "conv" not in plan_of(every.filter(hashed < "01"))

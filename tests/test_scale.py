"""Operators on tables large enough for several partitions, against what must hold at any size."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from evigraph.operators import cooccurrence, features, graph, modeling, quality, similarity


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in (name.replace("__", ".") for name in values)}
    for name, value in values.items():
        spark.conf.set(name.replace("__", "."), value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("adaptive, partitions", [("true", "4"), ("true", "200"), ("false", "4"), ("false", "200")])
def test_dense_ids_of_many_rows(spark, adaptive, partitions):
    """A million rows with payload: each once, ids 0 to n - 1 in order."""
    n = 1_000_000
    rows = spark.range(n).select(F.xxhash64("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("payload"), (F.col("id") % 3).alias("label"))
    with settings(spark, spark__sql__adaptive__enabled=adaptive, spark__sql__shuffle__partitions=partitions):
        found = graph.local_ids(graph.dense_ids(rows, ["label", "key"]), "label", "node_id").cache()
        r = found.agg(F.count("*").alias("n"), F.count_distinct("node_id").alias("ids"), F.min("node_id").alias("low"), F.max("node_id").alias("high"), F.count_distinct("key").alias("keys")).first()
        assert tuple(r) == (n, n, 0, n - 1, n)
        # In order: within blocks of ids, and from block to block.
        block = F.floor(F.col("node_id") / 1000)
        pair = F.struct("label", "key")
        inner = found.groupBy(block.alias("b")).agg(F.array_sort(F.collect_list(F.struct("node_id", pair.alias("k")))).alias("x")).select("b", F.col("x")[0]["k"].alias("low"), F.element_at("x", -1)["k"].alias("high"), (F.array_sort(F.transform("x", lambda v: v["k"])) == F.transform("x", lambda v: v["k"])).alias("sorted"))
        blocks = sorted(inner.collect())
        assert all(b.sorted for b in blocks) and all(a.high < b.low for a, b in zip(blocks, blocks[1:]))
        each = found.groupBy("label").agg(F.min("local_id").alias("low"), F.max("local_id").alias("high"), F.count_distinct("local_id").alias("ids"), F.count("*").alias("n")).collect()
        assert len(each) == 3 and all((r.low, r.high, r.ids) == (0, r.n - 1, r.n) for r in each)
        found.unpersist()


def test_dense_ids_of_equal_and_no_rows(spark):
    found = graph.dense_ids(spark.range(1000).select(F.lit(1).alias("k"), "id"), ["k"]).collect()
    assert sorted(r.node_id for r in found) == list(range(1000)) and sorted(r.id for r in found) == list(range(1000))
    assert graph.dense_ids(spark.range(0), ["id"]).count() == 0


def prints_by_force(prints, threshold, top):
    out = []
    for i, a in prints:
        scored = [(-len(a & b) / len(a | b), j) for j, b in prints if i != j and a and b and len(a & b) / len(a | b) >= threshold]
        out += [(i, j, pytest.approx(-s)) for s, j in sorted(scored)[:top]]
    return out


@pytest.mark.parametrize("block", [2048, 7])
def test_similar_prints(spark, block):
    import numpy as np

    rng = np.random.default_rng(4)
    base = [set(rng.choice(256, 30, replace=False).tolist()) for _ in range(12)]
    prints = []
    for k in range(90):
        bits = base[k % 12] ^ set(rng.choice(256, k % 7, replace=False).tolist())
        prints.append((k, bits if k % 11 else set()))
    prints += [(100 + k, base[0]) for k in range(30)] + [(200, {1}), (201, {1, 2}), (202, set(range(256)))]
    df = spark.createDataFrame([(i, sorted(b)) for i, b in prints], "id long, bits array<int>").repartition(3)
    found = similarity.neighbours(df, 0.6, 5, block).orderBy("id", F.desc("score"), "other").collect()
    assert [tuple(r) for r in found] == prints_by_force(prints, 0.6, 5)


def test_similar_prints_of_a_large_class(spark):
    """100,000 prints, 10,000 of them equal: as many rows as results, and no row twice."""
    bits = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(24)), lambda k: F.pmod(F.xxhash64(F.when(F.col("id") % 10 == 0, F.lit(-1)).otherwise(F.floor(F.col("id") / 20)), k), F.lit(256)).cast("int"))))
    prints = spark.range(100_000).select("id", bits.alias("bits"))
    found = similarity.neighbours(prints, 0.6, 5).cache()
    r = found.agg(F.count("*").alias("n"), F.count_distinct("id", "other").alias("pairs"), F.count_distinct("id").alias("ids"), F.count_if(F.col("id") == F.col("other")).alias("own"), F.min("score").alias("low")).first()
    assert (r.n, r.pairs, r.ids, r.own) == (500_000, 500_000, 100_000, 0) and r.low >= 0.6
    hot = {(x.id, x.other) for x in found.filter("id % 10 = 0 and id < 100").collect()}
    assert hot == {(i, j) for i in range(0, 100, 10) for j in [k for k in range(0, 60, 10) if k != i][:5]}
    found.unpersist()


def test_candidates_are_drawn_without_the_product(spark):
    compounds = spark.range(300).select(F.col("id").alias("cid"))
    proteins = spark.range(17).select((F.col("id") * 3).alias("protein_id"))
    observed = spark.range(0, 300, 2).select(F.col("id").alias("cid"), (F.col("id") % 17 * 3).alias("protein_id")).unionByName(spark.createDataFrame([(0, 0), (0, 0), (999, 0), (None, 3)], "cid long, protein_id long"))
    seen = {tuple(r) for r in observed.collect()}
    every = {(c, p * 3) for c in range(300) for p in range(17)} - seen
    for n, block in ((0, 64), (1000, 64), (1000, 1 << 16), (10_000, 64)):
        found = [tuple(r) for r in modeling.drawn_pairs(compounds, proteins, observed, n, block=block).collect()]
        assert len(found) == len(set(found)) == min(n, len(every)) and set(found) <= every
        a = set(found) if n == 1000 else a if n else None
    b = {tuple(r) for r in modeling.drawn_pairs(compounds, proteins, observed, 1000, 14).collect()}
    assert a != b and len(a & b) < 400
    # A longer sample starts with the shorter one, and partitions don't matter.
    assert a == {tuple(r) for r in modeling.drawn_pairs(compounds.repartition(5), proteins.repartition(3), observed, 1000).collect()}
    assert a < {tuple(r) for r in modeling.drawn_pairs(compounds, proteins, observed, 1500).collect()}
    plan = modeling.candidates(compounds, proteins, observed, 50)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert modeling.drawn_pairs(compounds.limit(0), proteins, observed, 5).count() == 0


def test_drawn_index_is_a_permutation(spark):
    found = [r.i for r in spark.range(1 << 12).select(modeling.drawn_index(F.col("id"), 6, 13).alias("i")).collect()]
    assert sorted(found) == list(range(1 << 12)) and found != sorted(found)


def test_mentions_of_frequent_and_long_terms(spark):
    texts = [f"The common word is in all {k} texts." for k in range(200)] + ["alpha-beta\n  gamma", "xalphax beta", "rat rats", "_rat", None, "", "rat, alpha beta"]
    terms = [(1, 0, "common"), (1, 1, "common word"), (2, 0, "rat"), (3, 0, "Alpha-Beta gamma"), (4, 0, "alpha"), (5, 0, "alphax"), (6, 0, " "), (7, 0, None)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    dictionary = spark.createDataFrame(terms, "term_id int, place int, phrase string")
    for most in (2_000_000, 5):  # one automaton, and one for each few phrases
        found = sorted(tuple(r)[:3] for r in similarity.mentions(df, dictionary, "doc_id", 25, most).collect())
        expected = [(k, 1, "common") for k in range(200)] + [(200, 3, "alpha-beta gamma"), (200, 4, "alpha"), (201, 5, "alphax"), (202, 2, "rat"), (206, 2, "rat"), (206, 4, "alpha")]
        assert found == sorted(expected)
    assert similarity.mentions(df, dictionary, "doc_id", 1).filter("doc_id = 200").collect()[0].term_id == 3
    assert similarity.mentions(df, dictionary.limit(0), "doc_id").count() == 0
    (r,) = similarity.mentions(df.filter("doc_id = 202"), dictionary, "doc_id").collect()
    assert r.snippet == "rat rats"


def test_target_dictionary(spark):
    rows = [("p1", 1, "Cyp2C9", "Cytochrome", "g1"), ("p1", 2, "other", None, None), ("p2", 1, None, "ab", " Kinase "), ("p3", 1, " ", None, "x"), (None, 1, "TP53", None, None)]
    df = spark.createDataFrame(rows, "protein_id string, seq int, symbol string, name string, gene string")
    found = [(r.term_id, r.place, r.term) for r in similarity.target_dictionary(df, "protein_id", "seq", "symbol", ["name", "gene"]).orderBy("term_id", "place").collect()]
    assert found == [("p1", 0, "CYP2C9"), ("p1", 1, "cytochrome P450 2C9"), ("p1", 2, "cytochrome P450 CYP2C9"), ("p1", 3, "Cyp2C9"), ("p1", 4, "Cytochrome"), ("p2", 0, "Kinase")]


def test_profile_of_five_thousand_columns(spark):
    import numpy as np

    wide, n = 5_000, 40
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1, (n, wide))
    x[rng.random((n, wide)) < 0.1] = np.nan
    x[:, 7] = 3.0
    df = spark.createDataFrame([(x[k].tolist(),) for k in range(n)], "v array<double>").repartition(3).select(*(F.col("v")[k].alias(f"c{k}") for k in range(wide)))
    found = {r.feature: r for r in features.profile(df).collect()}
    assert len(found) == wide and all(r.rows == n and r.kind == "number" for r in found.values())
    for k in (0, 7, 513, wide - 1):
        column = x[:, k][~np.isnan(x[:, k])]
        r = found[f"c{k}"]
        assert (r.n, r.empty) == (len(column), n - len(column)) and r.mean == pytest.approx(column.mean()) and r.m2 == pytest.approx(((column - column.mean()) ** 2).sum(), rel=1e-6, abs=1e-9)
        assert (r.low, r.high) == (column.min(), column.max())


def test_profile_of_odd_values(spark):
    rows = [("1", "x", 0.0, True, "a"), (" 2.5 ", "", float("inf"), None, "b"), (" ", None, float("nan"), True, "c"), (None, "3", None, False, "d")]
    df = spark.createDataFrame(rows, "number string, mixed string, `odd.name` double, flag boolean, k string")
    found = {r.feature: r for r in features.profile(df).collect()}
    r = found["number"]
    assert (r.kind, r.rows, r.n, r.mean, r.m2, r.empty, r.bad) == ("text", 4, 2, 1.75, 1.125, 2, 0)
    assert (found["mixed"].n, found["mixed"].bad, found["mixed"].empty) == (1, 1, 2)
    assert (found["odd.name"].n, found["odd.name"].zeros, found["odd.name"].infinite, found["odd.name"].empty) == (1, 1, 1, 2)
    assert (found["flag"].kind, found["flag"].empty, found["flag"].infinite) == ("other", 1, 0)
    assert features.numeric_columns(df) == ["number", "odd.name"]
    inside = {r.feature: r for r in features.profile(df, ["number"], F.col("k") == "b").collect()}["number"]
    assert (inside.rows, inside.n, inside.mean) == (4, 1, 2.5)
    assert features.profile(df.limit(0), ["number"]).first().n == 0 and features.profile(df, []).count() == 0


def test_cooccurrences_in_both_directions_with_caps(spark):
    rows = [
        ("cooccurrence:1", "p:a", "protein:A"), ("protein:B", "p:b", "cooccurrence:1"), ("cooccurrence:1", "p:c", "compound:CID1"), ("cooccurrence:1", "p:c", "compound:CID2"),
        *(("cooccurrence:1", "p:r", f"reference:{k}") for k in range(4)), ("cooccurrence:1", "x#score", "0.5"), ("cooccurrence:1", "x#sentenceCount", "7"),
        ("gene:G", "p:d", "cooccurrence:2"), ("cooccurrence:2", "p:x", "disease:D"), ("cooccurrence:3", "p:a", "protein:Z"), (None, "p", "protein:A"), ("other:9", "p", "protein:A"),
    ]
    triples = spark.createDataFrame(rows, "s string, p string, o string")
    targets = spark.createDataFrame([("protein:A",), ("protein:B",), ("gene:G",), (None,)], "target string")
    found = cooccurrence.cooccurrences(triples, targets, per_pair=2).collect()
    first = {(r.target, r.compound, r.protein, r.reference) for r in found if r.cooc_id == "cooc:1"}
    # The resource names protein A only; B is a target of the same rows, whose protein is A as well, so each is given once, for A.
    assert first == {("protein:A", f"compound:CID{c}", "protein:A", f"reference:{k}") for c in (1, 2) for k in range(2)}
    assert all((r.score, r.sentence_count) == (0.5, 7) for r in found if r.cooc_id == "cooc:1")
    (gene,) = [r for r in found if r.cooc_id == "cooc:2"]
    assert (gene.gene, gene.disease, gene.compound, gene.association_type) == ("gene:G", "disease:D", None, "entity cooccurrence")
    only = spark.createDataFrame([("compound:CID2",)], "compound string")
    assert {r.compound for r in cooccurrence.cooccurrences(triples, targets, only).collect()} == {"compound:CID2"}
    assert cooccurrence.cooccurrences(triples, targets, per_target=1, most=2).count() == 2


def test_entities_take_later_tables_last(spark):
    a = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "z", 0), (None, "n", 0)], "cid int, name string, seq int")
    b = spark.createDataFrame([(1, " ", "s"), (3, "w", None)], "cid int, name string, smiles string")
    found = sorted((r.cid, r.name, r.smiles) for r in graph.entities("cid", a, b, seq="seq").collect())
    assert found == [(1, "y", "s"), (2, "z", None), (3, "w", None)]
    plan = graph.entities("cid", a, b, seq="seq")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


def test_split_audit_of_odd_splits(spark):
    pairs = spark.createDataFrame([(1, "train", "1"), (2, None, "1"), (1, None, "0"), (None, "val", "unknown")], "cid int, split string, label string")
    found = {r.check_name: r.status for r in quality.split_audit(pairs, "cid", "split", "label", {}).collect()}
    assert found == {"label_balance_train": "high-risk", "label_balance_null": "pass", "label_balance_val": "pass", "overlap_null_vs_train": "high-risk", "train_only_edges": "review"}

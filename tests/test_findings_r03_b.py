"""More of what the third round's findings asked for: each of these failed before."""

from __future__ import annotations

from pyspark.sql import functions as F

from evigraph.operators import extract, mapping, modeling, scopes, similarity


def test_pairs_of_genes_are_not_shuffled(spark):
    """Proteins of one gene and of two, groups that name a protein and its gene, and blocks of proteins; nothing comes after the fan-out."""
    groups = range(12)
    genes_of = {f"protein:{k}": {f"gene:{k % 3}"} | ({"gene:0"} if k % 5 == 0 else set()) for k in range(30)}
    taking = {(f"mg:{m}", t) for m in groups for t in (f"gene:{m % 4}", f"gene:{m % 2}", f"protein:{m}", f"protein:{m * 3 + 90}", "other:1") if m % 6}
    want = {(m, p) for m, t in taking for p in ([t] if t.startswith("protein:") else [p for p, g in genes_of.items() if t in g])}
    named = spark.createDataFrame(sorted(taking) * 2, "mg string, target string")
    encoded = spark.createDataFrame([(g, p) for p, gs in genes_of.items() for g in gs] * 2 + [("gene:3", None)], "target string, protein string")
    for size in (100_000, 7):
        found = scopes._fanned_out(named, encoded, broadcast_rows=size)
        assert sorted(map(tuple, found.select("mg", "protein").collect())) == sorted(want)
    found = scopes.allowed_proteins(named, encoded)
    assert found._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
    star = spark.createDataFrame([(f"mg:{m}", e) for m in groups for e in "ab"[: m % 3]], "mg string, endpoint string")
    rows = scopes._fanned_out(named, encoded, star).select("mg", "protein", "endpoint").collect()
    assert sorted(map(tuple, rows)) == sorted((m, p, e) for m, p in want for e in "ab"[: int(m[3:]) % 3])


def test_comentions_through_genes_are_not_shuffled(spark):
    """The same features as of all pairs one by one; those through genes come last."""
    rows = lambda data, names: spark.createDataFrame(data, names)
    compounds = rows([(m, m % 5 if m % 7 else None) for m in range(60)] + [(m, 2) for m in range(0, 60, 4)], "mention_id long, cid long")
    proteins = rows([(m, m % 9) for m in range(0, 60, 2)] + [(7, None)], "mention_id long, protein_id long")
    genes = rows([(m, m % 4) for m in range(0, 60, 3)] * 2 + [(m, 0) for m in range(0, 60, 5)] + [(8, None)], "mention_id long, gene_id long")
    encoded = rows([(p % 3, p) for p in range(12)] + [(2, 3), (1, 3), (2, None), (None, 4)], "gene_id long, protein_id long")
    mentions = rows([(m, 0.5 if m % 3 else None, "text_mined_x" if m % 2 else None) for m in range(50)] + [(3, 0.9, None)], "mention_id long, score double, level string")
    references = rows([(m, m % 6) for m in range(40)] + [(m, 1) for m in range(40)], "mention_id long, reference_id long")
    plain = modeling.comention_pair_features(modeling.comention_pairs(compounds, proteins, genes, encoded, mentions), references)
    listed = lambda df: sorted(repr([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())
    for size in (100_000, 5):
        found = modeling.comention_features_through_genes(compounds, proteins, genes, encoded, mentions, references, size).select(*plain.columns)
        assert found._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
        assert listed(found) == listed(plain)


def test_raw_names_are_made_once(spark):
    """The names of a row's data fields were made anew within a function of them, so their number grew with its square."""
    data = {" a-b ": "1", "a b": "2", "__": "3", "a_b_": " ", "plain": "4", "x\n": "5", "known": "6", "none": None}
    rows = spark.range(1).select(F.create_map(*(F.lit(x) for pair in data.items() for x in pair)).alias("data"))
    found = rows.select(mapping.raw_fields(("known",)).alias("raw"))
    assert found.first().raw == {"raw_a_b": "1", "raw_value": "3", "raw_plain": "4", "raw_x": "5"}
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace") == 1


def test_ends_of_edges_are_made_once(spark):
    """The id of an interaction was made twice for each of its edges."""
    rows = spark.createDataFrame([("interaction", {"cid": "7", "protein_id": "P", "aid": "3"}, 1)], "kind string, data map<string,string>, seq long")
    found = mapping.edges_of(rows, ("interaction",))
    assert found._jdf.queryExecution().analyzed().toString().count("sha1(") == 1
    assert sorted(r.type for r in found.collect()) == ["ASSERTS_CHEMICAL", "ASSERTS_TARGET", "SUPPORTED_BY_ASSAY"]


def test_found_terms_go_back_in_parts(spark):
    """All that a batch of texts gives, with its snippets, was one Arrow batch; Spark may put any number of texts in one."""
    texts = spark.range(200).repartition(1).select("id", F.concat(F.lit("alpha beta gamma "), F.repeat(F.lit("x "), 300)).alias("text"))
    phrases = spark.createDataFrame([(w,) for w in ("alpha", "beta", "gamma", "delta")], "phrase string")
    found = similarity._searched(texts, phrases, "id", most=5_000)
    assert found.count() == 600 and found.distinct().count() == 600
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, similarity._searched(texts, phrases, "id").collect()))


def test_hops_of_the_star_are_shuffled_once(spark):
    """Each hop was shuffled to be made distinct, and again for its join."""
    P = extract.PREDICATES
    triples = spark.createDataFrame([("mg:1", P["participant"], "protein:1"), ("mg:1", P["output"], "e:1"), ("e:1", P["about"], "sid:1"), ("sid:1", P["standardized"], "cid:1"), ("aid:1", P["assay_group"], "mg:1")] * 2, "s string, p string, o string")
    found = extract.evidence_rows(triples)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 7
    assert [tuple(r) for r in found.select("mg", "endpoint", "substance", "compound", "target", "assay").collect()] == [("mg:1", "e:1", "sid:1", "cid:1", "protein:1", "aid:1")]

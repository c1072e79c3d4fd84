"""What the third round's findings of memory asked for: each of these failed before."""

from __future__ import annotations

import random
import re
import weakref

from evigraph import registry as queries_of_models
from evigraph.llm import arrow, bpe_codec, queries
from evigraph.operators import evidence, extract, records, scopes

from .conftest import SF


def test_memory_is_given_back_after_a_task_has_ended(spark, monkeypatch):
    """Tasks gave memory back while they still held their model, those that encode not at all."""

    class Model:
        pass

    models, seen = [], []

    def run(batches):
        model = Model()
        models.append(weakref.ref(model))
        yield from batches

    monkeypatch.setattr(arrow, "released", lambda pa: seen.append(models[-1]() is None))
    assert list(arrow.releasing(run)(iter([1, 2]))) == [1, 2]
    assert seen == [True]

    given = []
    monkeypatch.setattr(bpe_codec, "releasing", lambda run: given.append(run) or run)
    bpe_codec.encoded_digests(spark.read.parquet(f"{SF}/documents.parquet"), queries.vocabulary("byte_bpe_multi_50k.tiktoken"))
    assert len(given) == 1 and next(given[0](iter([])), None) is None


def test_first_of_a_hop_are_taken_before_the_join(spark):
    """All subjects of an object (a gene's groups) were put into one task to be made distinct; tasks did not grow in number with rows."""
    dice = random.Random(3)
    rows = [(f"mg:{dice.randrange(60)}", extract.PREDICATES["participant"], f"gene:{dice.randrange(4)}") for _ in range(600)]
    rows += [("mg:1", "x:other", "gene:9")]
    triples = spark.createDataFrame(rows, "s string, p string, o string")
    pairs = {(s, o) for s, p, o in rows if p != "x:other"}
    for cap in (1, 3, 1000):
        found = extract.subjects_of(spark.createDataFrame([("gene:1",), ("gene:1",), ("gene:3",), ("gene:9",)], "o string"), triples, "participant", cap, rows_of_task=50)
        assert sorted(map(tuple, found.select("s", "o").collect())) == sorted(x for o in ("gene:1", "gene:3") for x in sorted(p for p in pairs if p[1] == o)[:cap])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(s" in plan and ", 12), REPARTITION_BY_NUM" in plan and "Broadcast" not in plan
        found = extract.objects_of(spark.createDataFrame([("mg:1",), ("mg:1",), ("mg:7",), ("mg:99",)], "s string"), triples, "participant", cap)
        assert sorted(map(tuple, found.select("s", "o").collect())) == sorted(x for s in ("mg:1", "mg:7") for x in sorted(p for p in pairs if p[0] == s)[:cap])


def test_affinity_fields_are_made_once(spark):
    """Each of 58 names was looked for by itself, and again for every use of a field."""
    made = [
        {"BDB_MonomerID": "m1", "Ligand ID": "l1", "Kd (nM)": "5", "kd": " ", "PubChem CID": "CID 12"},
        {"Hit-ID": "h", "Ligand": "g", "IC50": "7", "affinity": "8", "PMID": "1", "doi": "2"},
        {"pubchem_cid": "none", "note": "n"},
        {"SMILES": "CC", "smile": "CO", "note": "n"},
        {"monomer id": "b", "Monomer-ID": "a"},
        {},
    ]
    rows = spark.createDataFrame([(k, f"P{k}", m) for k, m in enumerate(made)], "protein_id int, uniprot_acc string, record map<string, string>")
    found = records.affinity_rows(rows)

    def value(record, field):
        plain = [(re.sub("[^a-z0-9]+", "", key.lower()), v) for key, v in sorted(record.items()) if v.strip()]
        return next((v for name in records.AFFINITY_ALIASES[field] for key, v in plain if key == name), None)

    expected = {}
    for k, m in enumerate(made):
        cid = re.search(r"\d+", value(m, "cid") or "")
        if any([value(m, "ligand_id"), cid, *(value(m, f) for f in ("smiles", "affinity_value", "kd", "ki", "ic50"))]):
            expected[k] = [int(cid.group()) if cid else None, *(value(m, f) for f in ("smiles", "kd", "ic50", "affinity_value", "source_ref"))]
    assert {r.protein_id: list(r)[1:] for r in found.select("protein_id", "cid", "smiles", "kd", "ic50", "affinity_value", "source_ref").collect()} == expected
    assert [r.ligand_id for r in found.orderBy("protein_id").collect() if not r.ligand_id.startswith("P")] == ["l1", "g", "a"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_entities_and_links_are_grouped_by_texts(spark):
    """Rows were grouped by arrays of names and values."""
    rows = spark.createDataFrame([(1, 5, None, 3), (1, 5, 2, 2), (1, None, 2, 4), (None, None, 2, 1)], "mg int, cid int, protein int, seq int")
    found = scopes.entities_and_links(rows, {"group": "mg", "compound": "cid"}, {"taking": ("mg", "protein")}, "seq")
    assert sorted((r.row_kind, sorted(r["data"].items()), r.first_seq) for r in found.collect()) == [("compound", [("cid", "5")], 2), ("group", [("mg", "1")], 2), ("taking", [("mg", "1"), ("protein", "2")], 2)]
    assert "map_entries" not in found._jdf.queryExecution().analyzed().toString()


def test_measurements_are_shuffled_once_before_their_substance(spark):
    """Measurements were shuffled to be made distinct, and again to be joined with their substance."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = evidence.evidence_paths(spark.createDataFrame([("e1", 1, 2), ("e1", 1, 2)], "endpoint_id string, mg_id int, sid int"), spark.createDataFrame([(2, 3)], "sid int, cid int"), spark.createDataFrame([(1, 4)], "mg_id int, protein_id int"))
        assert found.count() == 1
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_binding_pairs_broadcast_no_measurements(spark):
    """Measurements, substances and groups were broadcast while their files were small, and held by every task."""
    plan = queries_of_models.QUERIES["j27_binding_pairs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [sid" in plan and "SortMergeJoin [mg_id" in plan

"""Readers and writers on small files."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from evigraph.plans import plugins
from evigraph.sources import readers, writers


def test_lists_and_json(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# seeds\nP1\n\n P2 \n")
    assert [r.id for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["P1", "P2"]
    (tmp_path / "rows.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert [r.a for r in readers.json_lines(spark, str(tmp_path / "rows.jsonl"), "a int").collect()] == [1, 2]


def test_ntriples_plain_and_gzip(spark, tmp_path):
    text = '<s> <p> <o> .\n# no\n_:b <p> "text \\" more"@en .\n'
    (tmp_path / "a.nt").write_text(text)
    with gzip.open(tmp_path / "b.nt.gz", "wt") as out:
        out.write(text)
    for name in ("a.nt", "b.nt.gz"):
        assert [tuple(r) for r in readers.ntriples(spark, str(tmp_path / name)).collect()] == [("<s>", "<p>", "<o>"), ("_:b", "<p>", '"text \\" more"@en')]


def test_delimited(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("Compound Name\tCID\tscore\nx\t5\t0.5\n\t6\t\n")
    found = readers.delimited(spark, str(tmp_path / "t.tsv"), {"compound": ["compound_name", "cid"], "none": ["zzz"]}).collect()
    assert [(r.compound, r.none) for r in found] == [("x", None), ("6", None)]


def test_schema_document(spark, tmp_path):
    (tmp_path / "s.dot").write_text('digraph {\n a [label="Compound\\nkey"];\n b [label="Protein"];\n a -> b [label="ACTS_ON | BINDS"];\n}\n')
    assert sorted(map(tuple, readers.schema_document(spark, str(tmp_path / "s.dot")).collect())) == [("Compound", "ACTS_ON", "Protein"), ("Compound", "BINDS", "Protein")]


def test_bibliography_and_manifest(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<Set><PubmedArticle><MedlineCitation><PMID Version='1'>7</PMID><Article><ArticleTitle>T</ArticleTitle><Abstract><AbstractText Label='AIM'>x</AbstractText><AbstractText>y</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle></Set>"
    )
    (r,) = readers.bibliography(spark, str(tmp_path / "a.xml")).collect()
    assert (r.pmid, r.title, r.abstract) == ("7", "T", "AIM: x y")
    (tmp_path / "m.json").write_text(json.dumps({"run": "r2", "taxid": None}))
    (tmp_path / "n.json").write_text(json.dumps({"run": "r1", "taxid": 9606}))
    m = readers.manifest(spark, str(tmp_path / "m.json"), str(tmp_path / "n.json")).first()
    assert (m.run, m.taxid) == ("r2", 9606)
    assert readers.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "m.json")]).endswith("m.json")


def test_cross_references(spark):
    df = spark.sql("SELECT 'P' AS id, array(named_struct('database', 'GO', 'id', 'GO:1', 'properties', map('GoTerm', 'F:heme binding', 'GoEvidenceType', 'IDA')), named_struct('database', 'PDB', 'id', '1X', 'properties', map('GoTerm', cast(null as string)))) AS xrefs")
    (r,) = readers.cross_references(df, "id", "xrefs", "GO").collect()
    assert (r.ref_id, r.aspect, r.name, r.evidence) == ("GO:1", "F", "heme binding", "IDA")


def test_flat_values(spark):
    df = spark.createDataFrame([(1, '{"a b": {"Ki": [1, 2]}, "c": "x"}'), (2, "broken")], "id int, j string")
    assert sorted((r.path_key, r.value) for r in readers.flat_values(df, "id", "j").collect()) == [("abki", "1"), ("abki", "2"), ("c", "x")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], ("x\ny",))], "id int, tags array<string>, s struct<t:string>")
    writers.write_csv(df, str(tmp_path / "csv"), ["id"])
    found = spark.read.option("header", True).csv(str(tmp_path / "csv")).first()
    assert (found.id, found.s_t, found.tags) == ("1", "x y", "a | b")
    row = writers.manifest_row(spark, {"run": "r", "n": 3}).first()
    assert len(row.content_sha256) == 64
    table = spark.createDataFrame([(1, 0, "a")], "k int, seq int, v string")
    assert writers.upserted(table, spark.createDataFrame([(1, 1, None), (2, 1, "b")], table.schema), ["k"], "seq").orderBy("k").collect() == [(1, "a"), (2, "b")]


def test_plugins(spark):
    class Good:
        name = "good"

        def enabled(self, settings):
            return True

        def rows(self, spark, tables):
            return spark.range(2)

    class Bad(Good):
        name = "bad"

        def rows(self, spark, tables):
            raise RuntimeError("no")

    plugins.register("good")(Good)
    seen = {}
    status = plugins.apply([*plugins.load(["good", "good"]), Bad()], spark, {}, {}, lambda n, df: seen.update({n: df.count()}))
    assert status == {"good": "written", "bad": "failed"} and seen == {"good": 2}
    assert F is not None


def test_built_in_layers(spark):
    from evigraph.operators import mapping
    from evigraph.plans import layers

    assert {"uniprot", "go", "reactome", "interpro", "pdb", "alphafold", "chembl", "bindingdb", "bindingdb_file", "drugbank", "pubchem", "molgraph", "protembed"} == set(layers.LAYERS)
    compounds = spark.createDataFrame([(1, "C2H6O", "CCO", "K1"), (2, None, " ", "K2"), (None, "C", "C", None)], "cid long, formula string, smiles string, inchikey string")
    proteins = spark.createDataFrame([("ACCP1", "P1", "MK-V"), ("ACCP2", "P2", None)], "protein_id string, uniprot_acc string, sequence string")
    drugs = spark.createDataFrame([("D1", "1", "P1", None, "x"), (None, "7", None, None, None), (None, None, "P2", None, None)], "drug_id string, cid string, uniprot_acc string, protein_id string, source string")
    molecules = spark.createDataFrame([("K1", "CHEMBL5")], "inchikey string, chembl_id string")
    rows, status = layers.layer_rows(spark, {"compounds": compounds, "proteins": proteins, "drug_file": drugs, "molecules": molecules}, ["molgraph", "protembed", "drugbank", "chembl", "bindingdb"])
    assert status == {"molgraph": "written", "protembed": "written", "drugbank": "written", "chembl": "written", "bindingdb": "failed"}
    found = {}
    for r in rows.collect():
        found.setdefault(r.kind, []).append(r.data)
    assert [d["cid"] for d in found["molgraph"]] == ["1"] and json.loads(found["molgraph"][0]["elements"]) == {"C": 2, "H": 6, "O": 1}
    assert [d["protein_id"] for d in found["protembed"]] == ["ACCP1"] and len(json.loads(found["protembed"][0]["embedding"])) == 20
    assert sorted((d.get("drug_id", "")[:5], d["protein_id"], d["source"]) for d in found["drugbank"]) == [("D1", "ACCP1", "x"), ("drug:", "ACCP2", "local import")]
    assert found["chembl"][0]["chembl_id"] == "CHEMBL5"
    # The graph takes them as they are.
    assert mapping.nodes_of(rows, ("molgraph",)).filter("label = 'MolGraph'").count() == 1

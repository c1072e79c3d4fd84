"""Extracted rows to nodes and edges.

A row is ``kind STRING, data MAP<STRING, STRING>, seq BIGINT``. What a kind gives is declared as plain specifications:
nodes with a key and properties, each property with the data fields that it is taken from (the first that is not
blank) or an expression over them, and edges between keys. One pass over the rows explodes all nodes, one all edges.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, node_ref, stable_id

#: Data fields in order of preference, or what makes a value of them.
Sources = tuple[str, ...] | Callable[[], Column]


@dataclass(frozen=True)
class Node:
    """A node of ``label`` with the key field ``key``, from the first of ``sources``; ``sidecar`` nodes need a property
    besides their key. With ``raw``, data fields that are no property of the node are carried over as ``raw_*``."""

    label: str
    key: str
    sources: Sources
    props: dict[str, Sources] = field(default_factory=dict)
    sidecar: bool = False
    raw: bool = False


@dataclass(frozen=True)
class Edge:
    """An edge of ``type`` between two keyed labels; only where both keys are there, and the sidecar's fields if given."""

    type: str
    start: tuple[str, str, Sources]
    end: tuple[str, str, Sources]
    needs: tuple[str, ...] = ()
    listed: bool = False


def _same(*names: str) -> dict[str, tuple[str, ...]]:
    return {n: (n,) for n in names}


CID, SID, AID = ("Compound", "cid", ("cid",)), ("Substance", "sid", ("sid",)), ("BioAssay", "aid", ("aid",))
MG, EP, PROTEIN = ("MeasureGrp", "mg_id", ("mg_id",)), ("Endpoint", "endpoint_id", ("endpoint_id",)), ("Protein", "protein_id", ("protein_id",))
GENE, TAXON, REFERENCE = ("Gene", "gene_id", ("gene_id",)), ("Organism", "taxid", ("taxid", "tax_id")), ("Reference", "reference_id", ("reference_id", "ref_id", "pmid"))
SOURCE, CELL, ANATOMY = ("Source", "source_id", ("source_id", "source_term", "source_name")), ("CellLine", "cell_id", ("cell_id",)), ("Anatomy", "anatomy_id", ("anatomy_id",))
DISEASE, PATHWAY, COOC, TEXT = ("Disease", "disease_id", ("disease_id",)), ("Pathway", "pathway_id", ("pathway_id",)), ("CoOccurrence", "cooc_id", ("cooc_id",)), ("TextMine", "textmine_id", ("textmine_id",))

# Labels, keys, field names and edge types of the graph schema, by kind of row.
STRUCTURE = {"smiles": ("smiles", "canonical_smiles", "isomeric_smiles"), "canonical_smiles": ("canonical_smiles", "smiles"), **_same("isomeric_smiles", "inchi", "inchikey")}
PROPERTIES = _same("formula", "molecular_weight", "exact_mass", "xlogp3", "tpsa", "hbond_donor_count", "hbond_acceptor_count", "rotatable_bond_count")
NAME = {"name": ("name", "label", "title")}
SPECIFICATIONS: dict[str, tuple[list[Node], list[Edge]]] = {
    "compound": (
        [Node(*CID, {"preferred_name": ("preferred_name", "name", "title")}), Node("Structure", "cid", ("cid",), STRUCTURE, True), Node("Properties", "cid", ("cid",), PROPERTIES, True), Node("Synonyms", "cid", ("cid",), _same("synonyms"), True)],
        [
            Edge("HAS_STRUCTURE", CID, ("Structure", "cid", ("cid",)), tuple(STRUCTURE)),
            Edge("HAS_PROPERTIES", CID, ("Properties", "cid", ("cid",)), tuple(PROPERTIES)),
            Edge("HAS_SYNONYMS", CID, ("Synonyms", "cid", ("cid",)), ("synonyms",)),
            Edge("SIMILAR_TO", CID, ("Compound", "cid", ("similar_compounds",)), listed=True),
            Edge("HAS_PARENT_COMPOUND", CID, ("Compound", "cid", ("parent_compounds",)), listed=True),
            Edge("HAS_COMPONENT_COMPOUND", CID, ("Compound", "cid", ("component_compounds",)), listed=True),
        ],
    ),
    "structure": ([Node("Structure", "cid", ("cid",), STRUCTURE, True)], [Edge("HAS_STRUCTURE", CID, ("Structure", "cid", ("cid",)), tuple(STRUCTURE))]),
    "substance": ([Node(*SID, {"record_name": ("record_name", "title", "name")}), Node(*SOURCE, {"name": ("source_name", "source_term")})], [Edge("SUBMITTED_BY", SID, SOURCE), Edge("STANDARDIZED_TO", SID, CID)]),
    "protein": ([Node(*PROTEIN, {**NAME, **_same("sequence", "taxid", "domain")}), Node(*GENE, {"symbol": ("gene_symbol", "symbol")})], [Edge("ENCODED_BY", PROTEIN, GENE)]),
    "gene": ([Node(*GENE, {"symbol": ("symbol", "gene_symbol"), **NAME})], []),
    "organism": ([Node(*TAXON, {"scientific_name": ("scientific_name", "name"), **_same("common_name")})], []),
    "bioassay": ([Node(*AID, {"title": ("title", "name", "assay_title"), "assay_type": ("assay_type", "type")}), Node(*SOURCE, {"name": ("source_name", "source_term")})], [Edge("HAS_SOURCE", AID, SOURCE)]),
    "measuregroup": ([Node(*MG, _same("name"))], [Edge("HAS_MEASURE_GROUP", AID, MG)]),
    "endpoint": ([Node(*EP, {"endpoint_type": ("endpoint_type", "type"), "outcome_label": ("label", "outcome"), **_same("value", "unit", "qualifier", "score")})], [Edge("ABOUT_SUBSTANCE", EP, SID), Edge("HAS_ENDPOINT", MG, EP)]),
    "reference": ([Node(*REFERENCE, _same("title", "doi", "pmid", "year"))], []),
    "cellline": ([Node(*CELL, NAME)], []),
    "anatomy": ([Node(*ANATOMY, NAME)], []),
    "disease": ([Node(*DISEASE, NAME)], []),
    "pathway": ([Node(*PATHWAY, NAME)], []),
    "mg_bioassay": ([], [Edge("HAS_MEASURE_GROUP", AID, MG)]),
    "mg_protein": ([], [Edge("TESTED_ON", MG, PROTEIN)]),
    "mg_gene": ([], [Edge("TESTED_ON", MG, GENE)]),
    "mg_organism": ([], [Edge("IN_ORGANISM", MG, TAXON)]),
    "mg_cellline": ([], [Edge("IN_CELL_LINE", MG, CELL)]),
    "cell_anatomy": ([], [Edge("DERIVED_FROM", CELL, ANATOMY)]),
    "ep_reference": ([], [Edge("SUPPORTED_BY", EP, REFERENCE)]),
    "protein_pathway": ([], [Edge("PARTICIPATES_IN", PROTEIN, PATHWAY)]),
    "textmine": ([Node(*TEXT, _same("snippet", "source", "score"))], []),
    "cooc": ([Node(*COOC, _same("score", "source"))], []),
    "cooc_compound": ([], [Edge("MENTIONS_COMPOUND", COOC, CID)]),
    "cooc_protein": ([], [Edge("MENTIONS_PROTEIN", COOC, PROTEIN)]),
    "cooc_gene": ([], [Edge("MENTIONS_GENE", COOC, GENE)]),
    "cooc_disease": ([], [Edge("MENTIONS_DISEASE", COOC, DISEASE)]),
    "cooc_reference": ([], [Edge("SUPPORTED_BY", COOC, REFERENCE)]),
    "cooc_textmine": ([], [Edge("DERIVED_FROM_TEXT", COOC, TEXT)]),
}


def _given(*names: str) -> Column:
    """The first of the data fields that is not blank, of ``_trimmed`` rows."""
    return F.coalesce(*(F.col("_given")[n] for n in names))


def _trimmed(rows: DataFrame) -> DataFrame:
    """``rows`` with the data fields that are not blank, trimmed once a row and not for each use of a field."""
    return rows.withColumn("_given", F.map_filter(F.transform_values("data", lambda k, v: F.trim(v)), lambda k, v: v != ""))


def _value(sources: Sources) -> Column:
    return sources() if callable(sources) else _given(*sources)


def _whole(name: str) -> Column:
    return _given(name).try_cast("long").cast("string")


def _address(prefix: str, *names: str) -> Callable[[], Column]:
    """An address made of an id, where there is one."""
    return lambda: F.concat(F.lit(prefix), _given(*names))


# Kinds of the optional layers. Fixed values as above.
UNIPROT, REACTOME = ("UniProt", "uniprot_acc", ("uniprot_acc", "accession", "acc")), ("Reactome", "reactome_id", ("reactome_id", "pathway_id", "id"))
GO, INTERPRO, ALPHAFOLD = ("GO", "go_id", ("go_id", "id")), ("InterPro", "interpro_id", ("interpro_id", "id")), ("AlphaFold", "alphafold_id", ("alphafold_id", "id", "model_id"))
PDB = ("PDB", "pdb_id", lambda: F.upper(_given("pdb_id", "id")))
PROTEMBED = ("ProtEmbed", "embedding_id", ("embedding_id", "id"))
MOLGRAPH = ("MolGraph", "repr_id", lambda: F.coalesce(_given("repr_id", "id"), F.concat(F.lit("molgraph:CID"), _whole("cid"), F.lit(":pubchem_features_v1"))))
CHEMBL, BINDINGDB, DRUGBANK = ("ChEMBL", "chembl_id", ("chembl_id", "id")), ("BindingDB", "bindingdb_id", ("bindingdb_id", "id")), ("DrugBank", "drugbank_id", ("drugbank_id", "id"))
PAIR_SEED = lambda: F.when(_whole("cid").isNotNull() & _given("protein_id").isNotNull(), stable_id(F.concat(F.lit("CID"), _whole("cid")), _given("protein_id"), prefix="interaction:"))
INTERACTION = ("Interaction", "interaction_id", lambda: F.coalesce(_given("interaction_id"), PAIR_SEED()))
BRIDGE = ("Pathway", "pathway_id", lambda: F.coalesce(_given("pathway_id"), F.concat(F.lit("Reactome:"), _given("reactome_id", "id"))))
NUMERIC_CID = ("Compound", "cid", lambda: _whole("cid"))
REACTOME_PAGE = _address("https://reactome.org/content/detail/", "reactome_id", "pathway_id", "id")
PDB_PAGE = lambda: F.concat(F.lit("https://www.rcsb.org/structure/"), F.upper(_given("pdb_id", "id")))
FORMULA_COUNTS = _same(*(f"formula_{x}_count" for x in ("atom", "c", "h", "n", "o", "s", "halogen", "hetero_atom", "element")))
SPECIFICATIONS |= {
    "uniprot": ([Node(*UNIPROT, {**_same("reviewed", "isoform_count", "function", "organism", "taxid", "sequence_length"), "protein_name": ("protein_name", "name")}, raw=True)], [Edge("HAS_UNIPROT_RECORD", PROTEIN, UNIPROT)]),
    "go": ([Node(*GO, {"name": ("name", "label"), **_same("aspect", "evidence_code")}, raw=True)], [Edge("HAS_GO_ANNOTATION", PROTEIN, GO)]),
    "reactome": (
        [
            Node(*REACTOME, {"name": ("name", "title", "label"), "species": ("species",), "pathway_id": BRIDGE[2], "source_url": REACTOME_PAGE}, raw=True),
            Node(*BRIDGE, {"title": ("name", "title", "label"), "name": ("name", "title", "label"), "source": lambda: F.lit("Reactome"), "pathway_type": lambda: F.lit("reactome"), "species": ("species",), "external_id": REACTOME[2], "source_url": REACTOME_PAGE}),
        ],
        [Edge("MAPS_TO_REACTOME_PATHWAY", PROTEIN, REACTOME), Edge("PARTICIPATES_IN", PROTEIN, BRIDGE), Edge("ALIGNS_TO_PATHWAY", REACTOME, BRIDGE)],
    ),
    "interpro": ([Node(*INTERPRO, {"name": ("name", "label"), "type": ("type",)}, raw=True)], [Edge("HAS_INTERPRO_DOMAIN", PROTEIN, INTERPRO)]),
    "pdb": ([Node(*PDB, {**_same("method", "resolution", "chain_map"), "pdb_url": lambda: F.coalesce(_given("pdb_url"), PDB_PAGE()), "source_url": lambda: F.coalesce(_given("source_url"), PDB_PAGE())}, raw=True)], [Edge("HAS_PDB_STRUCTURE", PROTEIN, PDB)]),
    "alphafold": (
        [Node(*ALPHAFOLD, {**_same("model_version", "average_plddt", "pdb_url", "cif_url", "pae_url", "model_status"), "confidence_summary": ("confidence_summary", "plddt_summary"), "storage_uri": ("storage_uri", "pdb_url", "cif_url")}, raw=True)],
        [Edge("HAS_ALPHAFOLD_MODEL", PROTEIN, ALPHAFOLD)],
    ),
    "protembed": ([Node(*PROTEMBED, _same("method", "dim", "storage_uri", "version"), raw=True)], [Edge("HAS_PROTEIN_EMBEDDING", ("UniProt", "uniprot_acc", ("uniprot_acc",)), PROTEMBED), Edge("HAS_PROTEIN_EMBEDDING", PROTEIN, PROTEMBED)]),
    "molgraph": (
        [
            Node(
                *MOLGRAPH,
                {
                    **_same("cid", "fp_type", "dim", "storage_uri", "version", "isomeric_smiles", "inchi", "inchikey", "formula", "molecular_weight", "xlogp", "tpsa", "hbond_donor_count", "hbond_acceptor_count"),
                    **_same("rotatable_bond_count", "heavy_atom_count", "charge", "smiles_length", "fingerprint_available", "fingerprint_method", "fingerprint_nbits", "fingerprint_on_bits"),
                    **FORMULA_COUNTS,
                    "method": lambda: F.coalesce(_given("method"), F.lit("pubchem_features_v1")),
                    "smiles": ("smiles", "canonical_smiles", "isomeric_smiles"),
                    "canonical_smiles": ("canonical_smiles", "smiles"),
                },
                raw=True,
            )
        ],
        [Edge("HAS_MOLECULAR_REPRESENTATION", NUMERIC_CID, MOLGRAPH)],
    ),
    "chembl": ([Node(*CHEMBL, _same("entity_type", "assay_id", "activity_id"), raw=True)], [Edge("HAS_CHEMBL_RECORD", NUMERIC_CID, CHEMBL), Edge("HARMONIZED_TO_CHEMBL", EP, CHEMBL)]),
    "bindingdb": (
        [
            Node(*BINDINGDB, _same("ligand_id", "target_uniprot_acc", "kd", "ki", "ic50", "affinity_type", "affinity_value", "smiles", "inchikey", "parse_status", "source_ref", "source_url"), raw=True),
            Node(*NUMERIC_CID, {"preferred_name": ("ligand_name", "monomer_name")}),
            Node("Structure", "cid", lambda: F.when(_given("bindingdb_id", "id").isNotNull(), _whole("cid")), {"smiles": ("smiles",), "canonical_smiles": ("smiles",), **_same("inchi", "inchikey")}, True),
        ],
        [
            Edge("HAS_BINDINGDB_RECORD", NUMERIC_CID, BINDINGDB),
            Edge("HAS_STRUCTURE", NUMERIC_CID, ("Structure", "cid", lambda: _whole("cid")), ("smiles", "inchi", "inchikey")),
            Edge("HAS_BINDINGDB_TARGET_RECORD", PROTEIN, BINDINGDB),
            Edge("VALIDATED_BY_BINDINGDB", EP, BINDINGDB),
        ],
    ),
    "drugbank": ([Node(*DRUGBANK, {"name": ("name", "label"), **_same("category", "mechanism")}, raw=True)], [Edge("HAS_DRUGBANK_RECORD", NUMERIC_CID, DRUGBANK), Edge("HAS_DRUGBANK_ENZYME_LINK", PROTEIN, DRUGBANK)]),
    "interaction": (
        [Node(*INTERACTION, _same("label", "confidence", "evidence_count", "aggregation_rule", "split", "created_by"), raw=True)],
        [
            Edge("ASSERTS_CHEMICAL", INTERACTION, NUMERIC_CID),
            Edge("ASSERTS_TARGET", INTERACTION, PROTEIN),
            Edge("SUPPORTED_BY_ENDPOINT", INTERACTION, EP),
            Edge("SUPPORTED_BY_ASSAY", INTERACTION, AID),
            Edge("SUPPORTED_BY_REFERENCE", INTERACTION, ("Reference", "reference_id", ("reference_id",))),
            Edge("SCOPED_TO_ORGANISM", INTERACTION, ("Organism", "taxid", ("taxid",))),
        ],
    ),
}
SPECIFICATIONS |= {"protein_embedding": SPECIFICATIONS["protembed"], "molecular_representation": SPECIFICATIONS["molgraph"]}


def raw_fields(known: tuple[str, ...]) -> Column:
    """The data fields that are none of ``known``, as ``raw_`` and their name in letters, digits and ``_``; nulls go, and of
    fields whose names become the same the first stays."""
    entries = F.map_entries(F.map_filter("data", lambda k, v: v.isNotNull()))
    plain = r"\A[0-9A-Za-z](?:[0-9A-Za-z_]*[0-9A-Za-z])?\z"
    made_safe = lambda k: F.coalesce(F.nullif(F.trim(F.regexp_replace(k, "[^0-9A-Za-z_]+", "_"), F.lit("_")), F.lit("")), F.lit("value"))
    safe = lambda e: F.when(e["key"].rlike(plain), e["key"]).otherwise(made_safe(e["key"]))

    def made(x):
        each = F.transform(x["entries"], lambda e, i: F.struct(F.get(x["names"], i).alias("key"), e["value"].alias("value"), i.alias("place")))
        first = F.filter(each, lambda e: (F.array_position(x["names"], e["key"]) == e["place"] + 1) & ~e["key"].isin(*known))
        return F.map_from_entries(F.transform(first, lambda e: F.struct(F.concat(F.lit("raw_"), e["key"]), e["value"])))

    # Names are made once a row: within a function of entries they would be made anew for each entry.
    return bound(made, entries=entries, names=F.transform(entries, safe))


def _props(node: Node) -> Column:
    entries = F.array(*(F.struct(F.lit(name), _value(sources)) for name, sources in node.props.items()))
    props = F.map_filter(F.map_from_entries(entries), lambda k, v: v.isNotNull()) if node.props else F.create_map().cast("map<string,string>")
    return F.map_concat(props, raw_fields((node.key, *node.props))) if node.raw else props


def _chosen(kinds: tuple[str, ...] | None):
    return [(kind, spec) for kind, spec in SPECIFICATIONS.items() if kinds is None or kind in kinds]


def _by_kind(rows: DataFrame, arrays: dict[str, Column], name: str) -> DataFrame:
    """``seq`` and each element of the array of a row's kind, in one pass."""
    chosen = None
    for kind, made in arrays.items():
        chosen = F.when(F.col("kind") == kind, made) if chosen is None else chosen.when(F.col("kind") == kind, made)
    return _trimmed(rows.filter(F.col("kind").isin(*arrays))).select("seq", F.explode(chosen).alias(name))


def nodes_of(rows: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """label, node_ref, props and seq of every node that the rows give. ``kinds`` are those to look at, all if None; fewer make
    a smaller plan."""
    arrays = {}
    for kind, (nodes, _) in _chosen(kinds):
        made = []
        for node in nodes:
            key, props = _value(node.sources), _props(node)
            there = key.isNotNull() & (F.size(props) > 0) if node.sidecar else key.isNotNull()
            made.append(F.when(there, F.struct(F.lit(node.label).alias("label"), node_ref(node.label, **{node.key: key}).alias("node_ref"), props.alias("props"))))
        if made:
            arrays[kind] = F.array_compact(F.array(*made))
    return _by_kind(rows, arrays, "n").select("n.label", "n.node_ref", "n.props", "seq")


def edges_of(rows: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """type, start_ref, end_ref and seq of every edge; lists of neighbours (`` | `` between ids) give one each, and an
    edge to itself goes. ``kinds`` as above."""
    arrays = {}
    for kind, (_, edges) in _chosen(kinds):
        if edges:
            arrays[kind] = _edges_of_kind(edges)
    return _by_kind(rows, arrays, "e").select("e.type", "e.start_ref", "e.end_ref", "seq").filter("start_ref != end_ref")


def _edges_of_kind(edges: list[Edge]) -> Column:
    """The edges of a row; the values of their ends are made once for all of them."""
    sources = list(dict.fromkeys(end[2] for edge in edges for end in (edge.start, edge.end)))

    def made(x):
        out = []
        for edge in edges:
            (a, a_key, a_from), (b, b_key, b_from) = edge.start, edge.end
            start, end = (x[f"v{sources.index(c)}"] for c in (a_from, b_from))
            there = start.isNotNull() & end.isNotNull()
            if edge.needs:
                there = there & _given(*edge.needs).isNotNull()

            def of(e, edge=edge, a=a, a_key=a_key, b=b, b_key=b_key, start=start):
                return F.struct(F.lit(edge.type).alias("type"), node_ref(a, **{a_key: start}).alias("start_ref"), node_ref(b, **{b_key: e}).alias("end_ref"))

            out.append(F.when(there, _each(F.split(end, r"\s*\|\s*"), of) if edge.listed else F.array(of(end))))
        return F.flatten(F.array_compact(F.array(*out)))

    return bound(made, **{f"v{i}": _value(c) for i, c in enumerate(sources)})


def _each(values: Column, make) -> Column:
    """``make`` of every value; a function of one argument, so that it gets no index."""
    return F.transform(values, lambda v: make(v))


def represented(compounds: DataFrame, molgraphs: DataFrame, method: str = "pubchem_features_v1") -> tuple[DataFrame, DataFrame]:
    """Placeholder representations of ``compounds(cid)`` that ``molgraphs(cid)`` lacks, as nodes, and the edges from every
    compound to its representations (``molgraphs(cid, repr_id)`` and placeholders)."""
    cid = F.col("cid").cast("string")
    own = F.concat(F.lit("molgraph:CID"), cid, F.lit(f":{method}"))
    missing = compounds.select("cid").distinct().join(molgraphs.select("cid").distinct(), "cid", "left_anti").select("cid", own.alias("repr_id"))
    nodes = missing.select(F.lit("MolGraph").alias("label"), node_ref("MolGraph", repr_id="repr_id").alias("node_ref"), F.create_map(F.lit("cid"), cid, F.lit("method"), F.lit(method), F.lit("placeholder"), F.lit("true")).alias("props"))
    every = molgraphs.select("cid", "repr_id").join(compounds.select("cid").distinct(), "cid", "left_semi").unionByName(missing).distinct()
    edges = every.select(F.lit("HAS_MOLECULAR_REPRESENTATION").alias("type"), node_ref("Compound", cid="cid").alias("start_ref"), node_ref("MolGraph", repr_id="repr_id").alias("end_ref"))
    return nodes, edges


def _picked(fields: tuple[str, ...]) -> Column:
    return F.map_filter("data", lambda k, v: k.isin(*fields) & (F.trim(v) != ""))


def written_back(rows: DataFrame, updates: dict[str, tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """``rows`` and, of each row of a kind of ``updates``, one more that updates the entity it is about: kind of entity, its
    key and the data fields that it takes. Rows without the key, or without such fields, update nothing. The new rows come
    after their sources (the same ``seq``), to be merged by the last non-empty value."""
    made = []
    for kind, (entity, key, fields) in updates.items():
        data = _picked(fields)
        one = _trimmed(rows.filter(F.col("kind") == kind)).select(F.lit(entity).alias("kind"), F.when(F.size(data) > 0, F.map_concat(F.create_map(F.lit(key), _given(key)), data)).alias("data"), "seq", _given(key).alias("_key"))
        made.append(one.filter("data is not null and _key is not null").drop("_key"))
    out = rows.select("kind", "data", "seq")
    for part in made:
        out = out.unionByName(part)
    return out

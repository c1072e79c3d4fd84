"""Records of outside sources as rows: proteins, structure models, molecules, affinities, drugs and compound properties.

Sources are tables of records in JSON or with columns of many names; what is fetched one by one elsewhere is a join here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.targets import cyp_symbol
from ..functions.text import first_text, stable_id
from .extract import known_or_missing
from .graph import capped

#: The part of a protein record that is read.
PROTEIN_RECORD = """primaryAccession STRING, uniProtkbId STRING, entryType STRING, sequence STRUCT<length: LONG, molWeight: LONG>,
organism STRUCT<scientificName: STRING, commonName: STRING, taxonId: LONG>,
proteinDescription STRUCT<recommendedName: STRUCT<fullName: STRUCT<value: STRING>>, submissionNames: ARRAY<STRUCT<fullName: STRUCT<value: STRING>>>>,
genes ARRAY<STRUCT<geneName: STRUCT<value: STRING>>>, comments ARRAY<STRUCT<commentType: STRING, texts: ARRAY<STRUCT<value: STRING>>>>,
uniProtKBCrossReferences ARRAY<STRUCT<database: STRING, id: STRING, properties: ARRAY<STRUCT<key: STRING, value: STRING>>>>"""

#: Fields that name the same thing in affinity records: letters and digits of their names, in order of preference.
AFFINITY_ALIASES = {
    "ligand_id": ("monomerid", "bindingdbmonomerid", "bindingdbligandid", "ligandid", "bdbmonomerid", "bdbprimary", "primary", "ligand", "hitid", "id"),
    "cid": ("pubchemcid", "pubchemcids", "cid", "pubchemcompoundid", "pubchemcompoundcid"),
    "smiles": ("smiles", "smile", "bdbsmile", "bdbsmiles", "ligandsmiles", "ligandsmile", "canonicalsmiles", "canonicalsmile", "isomericsmiles", "isomericsmile"),
    "inchikey": ("inchikey", "bdbinchikey", "ligandinchikey", "standardinchikey"),
    "inchi": ("inchi", "bdbinchi", "ligandinchi", "standardinchi"),
    "affinity_type": ("affinitytype", "bdbaffinitytype", "type", "affinitykind"),
    "affinity_value": ("affinity", "bdbaffinity", "affinityvalue", "value", "affinitynm", "bdbvalue"),
    "kd": ("kd", "bdbkd", "kdnm"),
    "ki": ("ki", "bdbki", "kinm"),
    "ic50": ("ic50", "bdbic50", "ic50nm"),
    "source_ref": ("pmid", "bdbpmid", "pubmedid", "doi", "reference", "articleid"),
}


def protein_records(records: DataFrame, json: str = "record") -> DataFrame:
    """Attribute rows of protein records ``(protein_id, record)``, with their cross references as an array."""
    r = records.withColumn("r", F.from_json(json, PROTEIN_RECORD))
    texts = lambda kind: F.filter("r.comments", lambda c: c["commentType"] == kind)
    name = F.coalesce("r.proteinDescription.recommendedName.fullName.value", F.get("r.proteinDescription.submissionNames", F.lit(0))["fullName"]["value"])
    symbol = F.get("r.genes", F.lit(0))["geneName"]["value"]
    accession = F.col("r.primaryAccession")
    return r.select(
        "protein_id",
        accession.alias("uniprot_acc"),
        (F.col("r.entryType") == "UniProtKB reviewed (Swiss-Prot)").alias("reviewed"),
        name.alias("protein_name"),
        symbol.alias("gene_symbol"),
        cyp_symbol(symbol, name, accession, F.col("r.uniProtkbId")).alias("cyp_symbol"),
        F.coalesce("r.organism.scientificName", "r.organism.commonName").alias("organism"),
        F.col("r.organism.taxonId").alias("taxid"),
        F.col("r.sequence.length").alias("sequence_length"),
        F.col("r.sequence.molWeight").alias("mass"),
        F.get(F.get(texts("FUNCTION"), F.lit(0))["texts"], F.lit(0))["value"].alias("function"),
        F.size(F.coalesce(texts("ALTERNATIVE PRODUCTS"), F.array())).alias("isoform_count"),
        F.col("r.uniProtkbId").alias("uniprot_id"),
        F.col("r.uniProtKBCrossReferences").alias("xrefs"),
    )


def xref_rows(records: DataFrame, database: str, cap: int | None = None) -> DataFrame:
    """protein_id, ref_id and the columns that a database's cross references have: GO aspect, name and evidence; Reactome
    name; InterPro name; PDB method, resolution and chains. At most ``cap`` a protein, in the record's order."""
    each = records.select("protein_id", F.posexplode(F.filter("xrefs", lambda x: (x["database"] == database) & x["id"].isNotNull())).alias("place", "x"))
    props = F.map_from_entries(F.array_distinct(F.transform(F.coalesce("x.properties", F.array()), lambda p: F.struct(p["key"], p["value"]))))
    each = each.withColumn("p", props)
    if cap is not None:
        each = each.filter(F.col("place") < cap)
    get = lambda name: F.try_element_at("p", F.lit(name))
    parts = F.split(get("GoTerm"), ":", 2)
    columns = {
        "GO": {"name": F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))), "aspect": F.when(F.size(parts) > 1, F.get(parts, F.lit(0))), "evidence_code": get("GoEvidenceType")},
        "Reactome": {"name": get("PathwayName")},
        "InterPro": {"name": get("EntryName")},
        "PDB": {"method": get("Method"), "resolution": F.regexp_extract(get("Resolution"), r"([0-9.]+)", 1).try_cast("double"), "chain_map": get("Chains")},
    }[database]
    return each.select("protein_id", F.col("x.id").alias("ref_id"), *(c.alias(name) for name, c in columns.items()))


def structure_models(proteins: DataFrame, models: DataFrame, cap: int | None = None) -> DataFrame:
    """A row for each model of a protein's accession, old and new field names alike; a protein without one keeps a row that
    is marked as not confirmed. ``proteins(protein_id, uniprot_acc)``, ``models(uniprot_acc, record)``: a map of texts."""
    field = lambda *names: first_text(*(F.col("record")[n] for n in names))
    given = F.coalesce(field("entryId", "modelEntityId", "modelIdentifier"), F.concat(F.lit("AF-"), "uniprot_acc", F.lit("-F1")))
    found = models if cap is None else capped(models, ["uniprot_acc"], [F.to_json("record")], cap)
    joined = proteins.join(found, "uniprot_acc", "left")
    return joined.select(
        "protein_id",
        "uniprot_acc",
        given.alias("alphafold_id"),
        field("latestVersion", "version").alias("model_version"),
        field("confidenceCategory").alias("confidence_summary"),
        field("uniprotAveragePlddt", "globalMetricValue").try_cast("double").alias("average_plddt"),
        field("pdbUrl", "cifUrl", "bcifUrl").alias("storage_uri"),
        F.when(F.col("record").isNull(), "url_pattern_fallback_unverified").otherwise("api_confirmed").alias("model_status"),
    )


def molecules_by_key(compounds: DataFrame, molecules: DataFrame, cap: int = 20) -> DataFrame:
    """Molecule records of ``compounds(cid, inchikey)`` by structure key, at most ``cap`` a compound in order of their id. No compound gets
    more than the first ``cap`` of a key, so that many go before the join, which else grows with the square of a key's rows."""
    first = capped(molecules.filter("chembl_id is not null and inchikey is not null"), ["inchikey"], [F.col("chembl_id")], cap)
    found = compounds.filter("inchikey is not null and cid is not null").join(first, "inchikey")
    return capped(found, ["cid"], [F.col("chembl_id")], cap).withColumn("entity_type", F.lit("molecule"))


def _plain(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def affinity_rows(records: DataFrame, cap: int | None = None) -> DataFrame:
    """Affinity records of proteins as rows with one set of names and a stable id: ``records(protein_id, uniprot_acc,
    record)``, a map of texts. Records that say nothing of a ligand or an affinity go."""
    fields = F.map_filter(F.col("record"), lambda k, v: F.trim(v) != "")
    # An entry's place tells its field and which of the field's names it has; the first entry of a field by place is its value.
    places = F.create_map(*(F.lit(x) for k, names in enumerate(AFFINITY_ALIASES.values()) for j, name in enumerate(names) for x in (name, 100 * k + j)))
    placed = F.transform(F.array_sort(F.map_entries(fields)), lambda e, number: F.struct(F.try_element_at(places, _plain(e["key"])).alias("place"), number.alias("number"), e["value"].alias("value")))
    entries = F.array_sort(F.filter(placed, lambda e: e["place"].isNotNull()))
    rows = records.withColumns({"_e": entries, "raw_record_hash": F.substring(F.sha1(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("record")))).cast("binary")), 1, 16)})

    def of(k: int):
        return F.get(F.filter("_e", lambda e: e["place"].between(100 * k, 100 * k + 99)), F.lit(0))["value"]

    # One generated row each: what is filtered and derived below would else make the fields anew for every use.
    found = F.inline(F.array(F.struct(*(of(k).alias(name) for k, name in enumerate(AFFINITY_ALIASES)))))
    rows = rows.select("protein_id", "uniprot_acc", "raw_record_hash", found)
    rows = rows.withColumn("cid", F.regexp_extract("cid", r"(\d+)", 1).try_cast("long"))
    rows = rows.filter(F.coalesce("ligand_id", F.col("cid").cast("string"), "smiles", "affinity_value", "kd", "ki", "ic50").isNotNull())
    ligand = F.coalesce("ligand_id", F.concat(F.lit("CID"), F.col("cid").cast("string")), F.concat_ws(":", "uniprot_acc", "raw_record_hash"))
    rows = rows.withColumn("ligand_id", ligand)
    rows = rows.withColumns({"bindingdb_id": F.concat_ws(":", F.lit("BindingDB"), "uniprot_acc", "ligand_id", "raw_record_hash"), "parse_status": parse_status(F.col("cid"))})
    return rows if cap is None else capped(rows, ["protein_id"], [F.col("bindingdb_id")], cap)


def _is(name: str):
    return lambda e: e["key"] == name


def parse_status(cid: Column) -> Column:
    return F.when(cid.isNotNull(), "compound_mapped").otherwise("target_level_no_pubchem_cid")


def ligand_compounds(ligands: DataFrame, structures: DataFrame) -> DataFrame:
    """``ligands`` with cid where it was null: by InChIKey, then SMILES, then InChI of ``structures(cid, inchikey, smiles,
    inchi)``; of several compounds the smallest id."""
    out = ligands
    for name in ("inchikey", "smiles", "inchi"):
        known = structures.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias(f"_{name}")).agg(F.min("cid").alias(f"_cid_{name}"))
        out = out.join(known, F.col(name) == F.col(f"_{name}"), "left").drop(f"_{name}")
    return out.withColumn("cid", F.coalesce("cid", "_cid_inchikey", "_cid_smiles", "_cid_inchi")).drop("_cid_inchikey", "_cid_smiles", "_cid_inchi")


def structure_seeds(seeds: DataFrame, structures: DataFrame, per_seed: int = 20) -> DataFrame:
    """The compounds of ``seeds(kind, id)``: a cid is its own, a structure (inchikey, smiles, inchi) stands for the first
    ``per_seed`` compounds that have it; each once."""
    own = seeds.filter("kind = 'cid'").select(F.col("id").try_cast("long").alias("cid"))
    parts = [own]
    for name in ("inchikey", "smiles", "inchi"):
        wanted = seeds.filter(F.col("kind") == name).select(F.col("id").alias(name)).distinct()
        parts.append(capped(wanted.join(structures.select(name, "cid").distinct(), name), [name], [F.col("cid")], per_seed).select("cid"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter("cid is not null").distinct()


def imported(rows: DataFrame, compounds: DataFrame, proteins: DataFrame, id_column: str, prefix: str) -> DataFrame:
    """Rows of a file (cid, uniprot_acc, protein_id and more) whose compound and target are known or absent, with a protein
    id made of the accession, an id made of the row where it has none, and ``parse_status``."""
    numbered = rows.withColumn("cid", F.regexp_extract(F.col("cid").cast("string"), r"(\d+)", 1).try_cast("long"))
    kept = known_or_missing(known_or_missing(numbered, "cid", compounds), "uniprot_acc", proteins)
    made = stable_id(F.to_json(F.struct(*sorted(rows.columns))), prefix=f"{prefix}:")
    return kept.withColumns(
        {
            "protein_id": F.coalesce(F.col("protein_id"), F.concat(F.lit("ACC"), "uniprot_acc")),
            id_column: F.coalesce(first_text(id_column), made),
            "parse_status": parse_status(F.col("cid")),
        }
    )


def drug_rows(rows: DataFrame, compounds: DataFrame, proteins: DataFrame, source: str) -> DataFrame:
    """Rows of a drug file whose compound and target are known or absent, as ``imported`` with drug_id, and the ``source`` where a row names
    none."""
    found = imported(rows, compounds, proteins, "drug_id", "drug").drop("parse_status")
    named = first_text("source") if "source" in rows.columns else F.lit(None).cast("string")
    return found.withColumn("source", F.coalesce(named, F.lit(source)))


def compound_records(cids: DataFrame, properties: DataFrame, synonyms: DataFrame, most: int = 10) -> DataFrame:
    """Properties of compounds with their first ``most`` synonyms (``synonyms(cid, place, synonym)``) and a title: the given
    one, the first synonym, or ``CID n``."""
    chosen = capped(synonyms, ["cid"], [F.col("place"), F.col("synonym")], most)
    lists = chosen.groupBy("cid").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "synonym"))), lambda x: x["synonym"]).alias("synonyms"))
    joined = cids.select("cid").distinct().join(properties, "cid", "left").join(lists, "cid", "left")
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.get("synonyms", F.lit(0)), F.concat(F.lit("CID "), F.col("cid").cast("string")))
    return joined.withColumn("title", title)

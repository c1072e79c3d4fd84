"""Properties of node records in one form: what can be inferred is added, what is given stays.

Each function takes a node's ``props`` (a map of texts) and its key and gives a map. Blank properties count as absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import targets as T
from .text import bound, cleaned, extracted, first_text, lookup, ref_keys, token

# Addresses of public records.
ASSAY_PAGE, PUBMED_PAGE, DOI_PAGE = "https://pubchem.ncbi.nlm.nih.gov/bioassay/", "https://pubmed.ncbi.nlm.nih.gov/", "https://doi.org/"
HUMAN = {"scientific_name": "Homo sapiens", "common_name": "human"}
SYMBOL_GENE = {symbol: gene for gene, symbol in T.GENE_SYMBOL.items()}


def given(props: Column) -> Column:
    """The properties that are not blank."""
    return F.map_filter(props, lambda k, v: F.trim(v) != "")


def completed(props: Column, defaults: dict[str, Column], fixed: dict[str, Column] | None = None) -> Column:
    """``props`` with ``defaults`` where it has no such property, and ``fixed`` in any case; nulls add nothing.

    The names are known, so each value is asked for once; a lambda over the map would evaluate all of them for every entry.
    """
    fixed, none = fixed or {}, F.lit(None).cast("string")
    names = list(dict.fromkeys([*defaults, *fixed]))
    value = lambda n: F.coalesce(fixed.get(n, none).cast("string"), F.when(F.trim(props[n]) != "", props[n]), defaults.get(n, none).cast("string"))
    made = F.map_filter(F.map_from_entries(F.array(*(F.struct(F.lit(n), value(n)) for n in names))), lambda k, v: v.isNotNull())
    return F.map_concat(F.map_filter(props, lambda k, v: ~k.isin(*names) & (F.trim(v) != "")), made)


def protein_props(props: Column, key: Column) -> Column:
    """Accession and, for P450 enzymes, symbol, family and gene id."""
    p = lambda *names: first_text(*(props[n] for n in names))

    def with_accession(x):
        accession = F.upper(F.substring_index(F.coalesce(p("uniprot_id", "uniprot_acc", "accession", "primary_accession"), T.accession(x["protein"], props["pubchem_uri"])), "-", 1))
        return bound(lambda y: with_symbol(x["protein"], y["accession"]), accession=accession)

    def with_symbol(protein, accession):
        symbol = T.cyp_symbol(props["cyp_symbol"], props["gene_symbol"], props["symbol"], p("name", "protein_name", "label", "title"), protein, accession, props["pubchem_uri"])
        return bound(lambda x: of(accession, x["symbol"]), symbol=symbol)

    def of(accession, symbol):
        named = {name: symbol for name in ("cyp_symbol", "target_symbol", "gene_symbol")}
        return completed(props, {"uniprot_id": accession, "accession": accession, **named, "target_family": F.when(symbol.isNotNull(), "CYP450"), "ncbi_gene_id": lookup(symbol, SYMBOL_GENE)})

    return bound(with_accession, protein=first_text(key, props["protein_id"]))


def gene_props(props: Column, key: Column) -> Column:
    """Gene id and, for P450 enzymes, symbol and family."""

    def with_symbol(x):
        symbol = F.coalesce(T.cyp_symbol(props["symbol"], props["gene_symbol"], props["cyp_symbol"], props["name"], x["gene"], props["pubchem_uri"]), lookup(x["gene"], T.GENE_SYMBOL))
        return bound(lambda y: of(x["gene"], y["symbol"]), symbol=symbol)

    def of(gene, symbol):
        named = {name: symbol for name in ("symbol", "gene_symbol", "cyp_symbol", "target_symbol")}
        return completed(props, {"gene_id": gene, "ncbi_gene_id": gene, **named, "target_family": F.when(symbol.isNotNull(), "CYP450")})

    return bound(with_symbol, gene=first_text(key, props["gene_id"], props["ncbi_gene_id"]))


def bioassay_props(props: Column, key: Column) -> Column:
    """Addresses, a title or a readable stand-in that is marked as one, and type and method in one form."""
    p = lambda *names: first_text(*(props[n] for n in names))

    def with_text(x):
        return bound(
            lambda y: with_found(x, y),
            stand_in=F.concat_ws(" ", F.lit("PubChem BioAssay"), F.concat(F.lit("AID "), x["aid"])),
            text=F.concat_ws(" ", x["title"], x["kind"], x["method"]),
            any_method=F.coalesce(x["method"], p("activity_method")),
        )

    def with_found(x, y):
        return bound(lambda z: of(x, y, z), found=F.when(y["any_method"].isNull(), T.outcome_method(y["text"])), assay_type=T.assay_type(y["text"]))

    def of(x, y, z):
        aid, title = x["aid"], x["title"]
        defaults = {
            "aid": aid,
            "pubchem_aid": aid,
            "pubchem_uri": F.concat(F.lit("bioassay:AID"), aid),
            "pubchem_url": F.concat(F.lit(ASSAY_PAGE), aid),
            "title": title,
            "assay_title": F.coalesce(title, y["stand_in"]),
            "display_title": F.coalesce(title, y["stand_in"]),
            "assay_title_is_fallback": title.isNull(),
            "assay_type_raw": x["kind"],
            "assay_type": F.coalesce(x["kind"], z["assay_type"]),
            "activity_outcome_method": F.coalesce(y["any_method"], z["found"]),
            "metadata_quality": F.when(F.coalesce(props["assay_title_is_fallback"] == "true", title.isNull()), "pubchem_rdf_minimal").otherwise("pubchem_rdf_title_present"),
        }
        fixed = {
            "has_title": F.when(title.isNotNull(), "true").otherwise(F.coalesce(cleaned(props["has_title"]), F.lit("false"))),
            "assay_type_normalized": z["assay_type"],
            "activity_outcome_method_normalized": F.when(y["any_method"].isNotNull(), token(y["any_method"])).otherwise(z["found"]),
        }
        return completed(props, defaults, fixed)

    kind, method = p("assay_type", "type", "raw_assay_type"), p("activity_outcome_method", "outcome_method", "method")
    return bound(with_text, aid=first_text(props["aid"], key), title=p("title", "name", "assay_title", "description"), kind=kind, method=method)


def reference_props(props: Column, key: Column) -> Column:
    """DOI, PMID and year, also where they stand inside the id, address or title; addresses, type and a title to show."""

    def with_raw(x):
        raw = F.concat_ws(" ", *map(cleaned, (x["reference"], props["raw_term"], props["pubchem_uri"], props["title"])))
        return bound(lambda y: with_ids(x["reference"], y["raw"]), raw=raw)

    def with_ids(reference, raw):
        doi = F.coalesce(cleaned(props["doi"]), extracted(raw, r"(10\.\d{4,9}/[^\s]+)"))
        number = F.coalesce(cleaned(props["pmid"]), extracted(raw, r"(?i)PMID[:_/\s]*(\d+)"))
        pmid = lambda x: F.coalesce(F.nullif(F.regexp_replace(x["number"], r"\D", ""), F.lit("")), x["number"])
        return bound(lambda x: of(reference, raw, x["doi"], x["pmid"]), doi=doi, pmid=bound(pmid, number=number))

    def of(reference, raw, doi, pmid):
        published = pmid.isNotNull() | doi.isNotNull()
        defaults = {
            "reference_id": reference,
            "external_id": F.coalesce(F.concat(F.lit("DOI:"), doi), F.concat(F.lit("PMID:"), pmid)),
            "doi_url": F.concat(F.lit(DOI_PAGE), doi),
            "url": F.concat(F.lit(PUBMED_PAGE), pmid, F.lit("/")),
            "pubmed_url": F.concat(F.lit(PUBMED_PAGE), pmid, F.lit("/")),
            "display_title": F.coalesce(cleaned(props["title"]), F.concat(F.lit("PubMed record "), pmid), F.concat(F.lit("DOI "), doi), reference),
            "metadata_quality": F.when(published, "publication_id_present").otherwise("pubchem_reference_minimal"),
        }
        kind = F.coalesce(cleaned(props["reference_type"]), T.reference_type(pmid, doi, F.coalesce(reference, raw)))
        fixed = {"doi": doi, "pmid": pmid, "year": F.coalesce(cleaned(props["year"]), T.publication_year(raw).cast("string")), "reference_type": kind, "has_external_publication_id": published}
        return completed(props, defaults, fixed)

    return bound(with_raw, reference=first_text(props["reference_id"], key, props["ref_id"]))


def organism_props(props: Column, key: Column) -> Column:
    """The taxonomy number, and names where it is the human one."""
    text = first_text(props["taxid"], key)
    taxid = F.coalesce(F.replace(text, F.lit("TAXID"), F.lit("")).try_cast("int").cast("string"), text)
    names = {name: F.when(taxid == "9606", value) for name, value in HUMAN.items()}
    return completed(props, {"taxonomy_id": taxid, "pubchem_uri": F.concat(F.lit("taxonomy:TAXID"), taxid), **names}, {"taxid": taxid})


#: The form of each label, and the key field of its references.
FORMS = {"Protein": (protein_props, "protein_id"), "Gene": (gene_props, "gene_id"), "BioAssay": (bioassay_props, "aid"), "Reference": (reference_props, "reference_id"), "Organism": (organism_props, "taxid")}


def with_normalized_props(nodes: DataFrame) -> DataFrame:
    """``nodes(label, node_ref, props)`` with the properties of proteins, genes, assays, references and organisms in their
    form; other nodes stay as they are."""
    given = nodes.withColumns({"props": F.coalesce("props", F.create_map().cast("map<string,string>")), "_keys": ref_keys("node_ref")})
    form = None
    for label, (make, key) in FORMS.items():
        made = bound(lambda x, make=make: make(F.col("props"), x["key"]), key=F.try_element_at("_keys", F.lit(key)))
        form = F.when(F.col("label") == label, made) if form is None else form.when(F.col("label") == label, made)
    return given.withColumn("props", form.otherwise(F.col("props"))).drop("_keys")

"""Identifiers of compounds, proteins and genes, and metadata of references, assays and organisms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, cleaned, col, extracted, first_text, identifier, lookup, relationship_type, stable_id, tail

# Accessions and gene ids of common P450 enzymes, and the forms that accessions and their names have.
ACCESSION_SYMBOL = {"P05177": "CYP1A2", "P11712": "CYP2C9", "P33261": "CYP2C19", "P10635": "CYP2D6", "P08684": "CYP3A4", "P20815": "CYP3A5", "Q7Z449": "CYP2U1", "Q96SQ9": "CYP2S1"}
GENE_SYMBOL = {"1544": "CYP1A2", "1559": "CYP2C9", "1557": "CYP2C19", "1565": "CYP2D6", "1576": "CYP3A4", "1577": "CYP3A5", "113612": "CYP2U1", "29785": "CYP2S1"}
ACCESSION = r"^(?:[A-NR-Z][0-9][A-Z0-9]{3}[0-9]|[OPQ][0-9][A-Z0-9]{3}[0-9])(?:-\d+)?$"
SYMBOL = r"\bCYP\s*([0-9][A-Z0-9]{1,7})\b"
FAMILY = r"(?i)cytochrome\s+p450\s+family\s+([0-9]+)\s+subfamily\s+([a-z])\s+member\s+([0-9a-z]+)"
SHORT = r"(?i)\bP450\s*[-_]?\s*([0-9][A-Z][0-9A-Z]{0,5})\b"
# Substrings that tell an assay's type, in order of precedence.
ASSAY_TYPES = {
    "binding": "binding|bind|affinity|ki|kd",
    "inhibition": "inhib|ic50|inhibitor",
    "activation": "activat|agonist",
    "metabolism": "metabol|substrate|turnover|clearance",
    "enzyme_activity": "enzyme|catalytic|km|vmax",
    "cell_based": "cell|cellular",
    "toxicity": "tox|cytotoxic|viability",
}
# Substrings that tell how an outcome was measured.
OUTCOME_METHODS = {"ic50": "ic50", "ec50": "ec50", "ac50": "ac50", "ki": "ki", "kd": "kd", "km": "km", "inhibition": "inhib", "activity": "activity"}


def accession(*values: Column | str) -> Column:
    """The first protein accession among the values (whole, after the last ``/`` or ``:``, or behind ACC), without isoform."""

    def of(c):
        def found(x):
            forms = [F.regexp_replace(F.trim(form), "^ACC", "") for form in (x["text"], tail(x["text"], "/"), tail(x["text"], ":"))]
            return F.coalesce(*(F.when(form.rlike(ACCESSION), F.substring_index(form, "-", 1)) for form in forms))

        return bound(found, text=F.upper(cleaned(c)))

    return F.coalesce(*map(of, values))


def cyp_symbol(*values: Column | str) -> Column:
    """The P450 symbol: named in a value, else by accession or gene id, else from a protein name."""
    prefixed = lambda c: F.concat(F.lit("CYP"), c)

    def of(text):
        parts = F.concat(*(F.upper(F.regexp_extract(text, FAMILY, k)) for k in (1, 2, 3)))
        return F.struct(
            prefixed(extracted(F.translate(F.upper(text), "-_", "  "), SYMBOL)).alias("named"),
            F.coalesce(lookup(accession(text), ACCESSION_SYMBOL), lookup(extracted(text, r"(\d{3,9})"), GENE_SYMBOL)).alias("known"),
            prefixed(F.when(text.rlike(FAMILY), parts).otherwise(F.upper(extracted(text, SHORT)))).alias("worded"),
        )

    first = lambda x, name: F.get(F.array_compact(F.transform(x["each"], lambda e: e[name])), F.lit(0))
    each = F.transform(F.array_compact(F.array(*map(cleaned, values))), lambda text: of(text))
    return bound(lambda x: F.coalesce(*(first(x, name) for name in ("named", "known", "worded"))), each=each)


def chemical_seed(c: Column | str) -> Column:
    """A compound seed as (kind, id): cid, sid, inchikey, inchi or smiles; null for a blank."""
    text = cleaned(c)
    end = tail(text, "/", ":")
    cid, sid = extracted(F.upper(end), r"^(?:CID)?\s*(\d+)$"), extracted(F.upper(end), r"^SID\s*(\d+)$")
    key = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$"
    as_struct = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("id"))
    return (
        F.when(text.isNull(), None)
        .when(text.startswith("InChI="), as_struct("inchi", text))
        .when(F.upper(text).rlike(key), as_struct("inchikey", F.upper(text)))
        .when(sid.isNotNull(), as_struct("sid", sid))
        .when(cid.isNotNull(), as_struct("cid", cid))
        .otherwise(as_struct("smiles", text))
    )


def target_seed(c: Column | str) -> Column:
    """A target seed as (kind, id): protein by accession, gene by number, else symbol; null for a blank."""
    text = cleaned(c)
    gene = extracted(F.upper(text), r"^(?:.*[/:])?(?:GID|GENE)?\s*(\d+)$")
    as_struct = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("id"))
    return F.when(text.isNull(), None).when(accession(text).isNotNull(), as_struct("protein", accession(text))).when(gene.isNotNull(), as_struct("gene", gene)).otherwise(as_struct("symbol", F.upper(text)))


def iri_term(c: Column | str) -> Column:
    """The last part of an address, or the text itself."""
    return cleaned(tail(F.regexp_replace(cleaned(c), "^<|>$", ""), "#", "/"))


def reference_identity(pmid: Column | str, doi: Column | str, raw: Column | str) -> Column:
    """PMID before DOI before the raw id; PMID and DOI are also found inside the raw id."""
    text = cleaned(raw)
    number = F.coalesce(F.nullif(F.regexp_replace(F.coalesce(cleaned(pmid), F.lit("")), r"\D", ""), F.lit("")), extracted(text, r"(?i)PMID[:_/\s]*(\d+)"))
    digital = F.coalesce(cleaned(doi), extracted(text, r"(10\.\d{4,9}/[^\s]+)"))
    return F.coalesce(F.concat(F.lit("PMID:"), number), F.concat(F.lit("DOI:"), digital), text)


def reference_type(pmid: Column | str, doi: Column | str, raw: Column | str) -> Column:
    text = F.upper(F.coalesce(cleaned(raw), F.lit("")))
    return (
        F.when(cleaned(pmid).isNotNull() | text.rlike("PMID|PUBMED"), "pubmed")
        .when(cleaned(doi).isNotNull() | text.contains("DOI"), "doi")
        .when(text.contains("PATENT"), "patent")
        .when(text.rlike("AID|PUBCHEM"), "pubchem")
        .otherwise("external")
    )


def publication_year(c: Column | str) -> Column:
    return extracted(col(c), r"\b((?:19|20)\d{2})\b").try_cast("int")


def _first_match(text: Column, table: dict[str, str]) -> Column:
    return F.coalesce(*(F.when(text.rlike(words), name) for name, words in table.items()))


def assay_type(*texts: Column | str) -> Column:
    """By substrings of the texts in order of precedence; unspecified if none; null if all are blank."""
    text = F.nullif(F.lower(F.concat_ws(" ", *map(cleaned, texts))), F.lit(""))
    return F.when(text.isNotNull(), F.coalesce(_first_match(text, ASSAY_TYPES), F.lit("unspecified")))


def outcome_method(c: Column | str) -> Column:
    return _first_match(F.lower(cleaned(c)), OUTCOME_METHODS)


def taxids(c: Column | str) -> Column:
    """All numbers of a taxonomy text as longs, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(cleaned(c), F.lit("")), F.lit(r"(\d+)")), lambda x: x.cast("long")))


def display_title(title: Column | str, aid: Column | str) -> Column:
    return F.coalesce(first_text(title), F.concat(F.lit("Assay "), col(aid).cast("string")))


def term_of(c: Column | str) -> Column:
    """``kind:id`` of a public record's address (``.../pubchem/kind/id``), or the text itself."""
    text = F.trim(col(c).cast("string"))
    address = r"^https?://rdf\.ncbi\.nlm\.nih\.gov/pubchem/([^/]+)/([^/?#]+)$"
    return F.when(text.rlike(address), F.concat_ws(":", F.regexp_extract(text, address, 1), F.regexp_extract(text, address, 2))).otherwise(text)


def term_number(c: Column | str, kind: str) -> Column:
    """The number of a term that ends in CID, SID, TAXID or GID and digits; null if it is of another kind."""
    return extracted(col(c), rf"{kind}(\d+)$").try_cast("long")


def term_accession(c: Column | str) -> Column:
    return extracted(col(c), r"ACC([^:]+)$")


#: Property names of a taxonomy number.
TAXID_NAMES = ("taxid", "taxonomy_id", "tax_id", "raw_taxid", "organism_taxid", "ncbi_taxid")


def taxids_of(props: Column) -> Column:
    """All taxonomy numbers of a map of texts, under any of their names, each once."""
    each = F.array(*(F.coalesce(F.replace(cleaned(props[n]), F.lit("TAXID"), F.lit("")).try_cast("int").cast("long"), extracted(cleaned(props[n]), r"(\d+)").try_cast("long")) for n in TAXID_NAMES))
    return F.array_sort(F.array_distinct(F.array_compact(each)))


def listed_taxids(c: Column | str) -> Column:
    """The numbers of a list parameter (commas or semicolons, ``TAXID`` before a number or not), in order, each once; null
    if there is none."""
    parts = F.transform(F.split(F.translate(F.coalesce(col(c), F.lit("")), ";", ","), ","), lambda p: F.regexp_replace(F.trim(p), "(?i)^TAXID", "").try_cast("int"))
    found = F.array_distinct(F.array_compact(parts))
    return F.when(F.size(found) > 0, found)


def listed_words(c: Column | str) -> Column:
    """The words of a list parameter in lower case with ``_`` for ``-``, in order, each once."""
    parts = F.transform(F.split(F.translate(F.coalesce(col(c), F.lit("")), ";", ","), ","), lambda p: F.replace(F.lower(F.trim(p)), F.lit("-"), F.lit("_")))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def source_name(c: Column | str) -> Column:
    """A source's name to show: the last part of an address that is one, else the text."""
    text = cleaned(c)
    last = F.substring_index(F.regexp_replace(text, "/+$", ""), "/", -1)
    return F.when(text.contains("/") & (last != "") & ~F.lower(last).startswith("http"), last).otherwise(text)


def source_id(given: Column | str, term: Column | str, name: Column | str) -> Column:
    """A source's id: given, or its term or name in the letters of an identifier, or a stable hash of these."""
    text = F.coalesce(first_text(term, name), F.lit("unknown-source"))
    return F.coalesce(cleaned(given), identifier(text), stable_id(text, prefix="source:"))


def node_uri(base: str, label: Column | str, key: Column | str) -> Column:
    """An address for a node: base, label and key, as they stand in addresses."""
    return F.concat(F.lit(base), F.url_encode(col(label)), F.lit("/"), F.url_encode(F.coalesce(identifier(key), F.lit("unknown"))))


def relationship_types(overrides: dict[tuple[str, str, str], str] | None = None) -> Column:
    """The type of a schema edge (start_label, end_label, label): an override, or its label in the form of a type."""
    key = F.concat_ws("\t", "start_label", "end_label", "label")
    known = {"\t".join(k): v for k, v in (overrides or {}).items()}
    return F.coalesce(lookup(key, known), relationship_type("label")) if known else relationship_type("label")

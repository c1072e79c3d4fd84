"""Descriptors of formulas, sequences and structure texts, and set similarity of fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
HYDROPHOBIC, CHARGED = "AILMFWVY", "DEKRH"
BITS = 256


def element_counts(formula: Column | str) -> Column:
    """A formula's atoms by element; repeated elements add up."""
    text = F.coalesce(col(formula), F.lit(""))
    names = F.regexp_extract_all(text, F.lit(r"([A-Z][a-z]?)(\d*)"), 1)
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"([A-Z][a-z]?)(\d*)"), 2), lambda n: F.coalesce(F.nullif(n, F.lit("")), F.lit("1")).cast("long"))
    pairs = F.zip_with(names, numbers, lambda e, n: F.struct(e.alias("e"), n.alias("n")))
    return F.map_from_entries(
        F.transform(F.array_distinct(names), lambda e: F.struct(e, F.aggregate(F.filter(pairs, lambda p: p["e"] == e), F.lit(0).cast("long"), lambda s, p: s + p["n"])))
    )


def clean_sequence(c: Column | str) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^A-Za-z]", ""))


def residue_count(sequence: Column, residues: str) -> Column:
    return F.length(sequence) - F.length(F.translate(sequence, residues, ""))


def composition(sequence: Column) -> dict[str, Column]:
    """Counts and shares of residues, and the hydrophobic and charged shares, by column name."""
    size = F.nullif(F.length(sequence), F.lit(0))
    out = {f"aa_{a}": residue_count(sequence, a) for a in AMINO_ACIDS}
    out |= {f"freq_{a}": F.round(residue_count(sequence, a) / size, 6) for a in AMINO_ACIDS}
    return out | {"hydrophobic_fraction": F.round(residue_count(sequence, HYDROPHOBIC) / size, 6), "charged_fraction": F.round(residue_count(sequence, CHARGED) / size, 6)}


def fingerprint(c: Column | str, bits: int = BITS) -> Column:
    """On-bits of a text: its distinct stretches of 2 to 4 characters, between marks, hashed by SHA-1."""
    text = F.concat(F.lit("^"), col(c), F.lit("$"))

    def of_length(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substr(text, i, F.lit(n)))
        return F.when(F.length(text) >= n, every).otherwise(F.array().cast("array<string>"))

    grams = [of_length(n) for n in (2, 3, 4)]
    hashed = F.transform(F.array_distinct(F.concat(*grams)), lambda g: (F.conv(F.substring(F.sha1(g.cast("binary")), 1, 8), 16, 10).cast("long") % bits).cast("int"))
    return F.array_sort(F.array_distinct(hashed))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared on-bits over all; 0 for two empty sets."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)), F.lit(0.0))

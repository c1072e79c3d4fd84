"""Small text, array and hash expressions used everywhere. All are built-in Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(make, **values: Column) -> Column:
    """``make`` of a struct of values that are computed once, however often it uses them. Without it each use is a copy of
    the whole expression, and copies of copies make plans that Spark takes minutes to look through."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(n) for n, v in values.items()))), lambda x: make(x)), F.lit(0))


def cleaned(c: Column | str) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def first_text(*columns: Column | str) -> Column:
    """The first of the columns that is not blank."""
    return F.coalesce(*map(cleaned, columns))


def lookup(key: Column, table: dict) -> Column:
    """The value of ``key`` in a small fixed table, or null."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def tail(c: Column, *separators: str) -> Column:
    """What follows the last of each separator in turn."""
    return reduce(lambda x, s: F.substring_index(x, s, -1), separators, c)


def extracted(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular-expression group, null where the pattern is not found."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def truthy(c: Column | str) -> Column:
    """Whether a text says yes; null counts as no."""
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin("1", "true", "yes", "y"), F.lit(False))


def number(c: Column | str) -> Column:
    """Text as a double; null where it is none."""
    return cleaned(c).try_cast("double")


def integer(c: Column | str) -> Column:
    """The first run of digits of a text as a long."""
    return extracted(cleaned(c), r"(\d+)").try_cast("long")


def identifier(c: Column | str) -> Column:
    """Text of letters, digits and ``: _ - .`` only; blank is null."""
    return F.nullif(F.regexp_replace(F.trim(col(c).cast("string")), r"[^A-Za-z0-9:_\-.]+", ""), F.lit(""))


def stable_id(*parts: Column | str, prefix: str = "", digits: int = 40) -> Column:
    """SHA-1 of the parts joined by ``|`` (null as empty), ``digits`` long, behind a prefix."""
    joined = F.concat_ws("|", *(F.coalesce(col(p).cast("string"), F.lit("")) for p in parts))
    return F.concat(F.lit(prefix), F.substring(F.sha1(joined.cast("binary")), 1, digits))


def token(c: Column | str) -> Column:
    """Lower-case words joined by ``_``; ``unspecified`` if there are none."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(cleaned(c), F.lit(""))), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(words, F.lit("")), F.lit("unspecified"))


def label_token(c: Column | str) -> Column:
    """A label in lower case after its last ``#`` and ``/``, with ``_`` for ``-`` and space; null counts as empty."""
    text = F.lower(F.trim(F.coalesce(col(c).cast("string"), F.lit(""))))
    return F.translate(tail(text, "#", "/"), "- ", "__")


def relationship_type(c: Column | str) -> Column:
    """An edge type from a schema label: words without parenthesised parts, upper case, joined by ``_``."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\\n|\n|/", " ")
    words = F.regexp_replace(F.regexp_replace(text, r"\([^)]*\)", ""), "[^A-Za-z0-9]+", "_")
    return F.coalesce(F.nullif(F.upper(F.trim(words, F.lit("_"))), F.lit("")), F.lit("RELATED_TO"))


def node_ref(label: str, **keys: Column | str) -> Column:
    """A canonical reference: label and ``key=value`` parts in key order, joined by ``|``."""
    return F.concat_ws("|", F.lit(label), *(F.concat(F.lit(f"{k}="), col(keys[k]).cast("string")) for k in sorted(keys)))


def ref_label(ref: Column | str) -> Column:
    return F.substring_index(col(ref), "|", 1)


def ref_keys(ref: Column | str) -> Column:
    """The keys of a reference as a map; empty where it has none."""
    parts = F.slice(F.split(col(ref), r"\|"), 2, 1000)
    return F.str_to_map(F.array_join(parts, "|"), F.lit("\\|"), F.lit("="))


def split_of(seed: Column | str) -> Column:
    """train, val or test (7 : 2 : 1) by the first 32 bits of the seed's SHA-1."""
    bucket = F.conv(F.substring(F.sha1(col(seed).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 10
    return F.when(bucket < 7, "train").when(bucket < 9, "val").otherwise("test")


def percent(part: Column, whole: Column, digits: int = 3) -> Column:
    return F.round(100 * part / whole, digits)


def searchable(c: Column | str) -> Column:
    """Lower-case text with single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"\s+", " "))


def contains_phrase(text: Column, phrase: Column) -> Column:
    """Whether a text has a phrase; a phrase of up to five letters or digits must stand as a word."""
    short = (F.length(phrase) <= 5) & phrase.rlike("^[A-Za-z0-9]+$")
    as_word = F.regexp_like(text, F.concat(F.lit(r"\b"), phrase, F.lit(r"\b")))
    return F.when(short, as_word).otherwise(F.contains(text, phrase))


def context(text: Column, phrase: Column, width: int = 500) -> Column:
    """About ``width`` characters of a text around the first place of a phrase."""
    start = F.greatest(F.lit(1), F.instr(text, phrase) - width // 2)
    return F.substr(text, start, F.lit(width))

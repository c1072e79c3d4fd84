"""Traversals over a triples table: hops, seeds to evidence, and the rows that come of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import capped, first_by

# Predicates of the source vocabulary.
PREDICATES = {
    "participant": "obo:RO_0000057",
    "output": "obo:OBI_0000299",
    "about": "obo:IAO_0000136",
    "standardized": "sio:CHEMINF_000477",
    "participates": "obo:RO_0000056",
    "encoded_by": "up:encodedBy",
    "symbol": "bao:BAO_0002870",
    "assay_group": "bao:BAO_0000209",
    "organism": "up:organism",
}


#: Rows of a hop that one task makes distinct and puts in order.
ROWS_OF_TASK = 250_000


def _first_of_hop(triples: DataFrame, predicate: str, keys: list[str], by: str, other: str, cap: int, rows_of_task: int) -> DataFrame:
    """Distinct (s, o) of a predicate, at most ``cap`` of each ``by``, the first in order of ``other``. As the cap is for each ``by``, it may
    come before a join by it. Rows are dealt by ``keys`` to a number of tasks that grows with them, which Spark doesn't lower, so a task's
    memory doesn't grow with the tables. Nor should what is joined to it be broadcast: every task would hold all of it, and Spark takes
    files of ids for smaller than they are in memory."""
    every = triples.filter(F.col("p") == PREDICATES[predicate]).select("s", "o")
    tasks = max(int(every.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-every.count() // rows_of_task))
    return capped(every.repartition(tasks, *keys).distinct(), [by], [F.col(other)], cap)


def objects_of(subjects: DataFrame, triples: DataFrame, predicate: str, cap: int | None = None, rows_of_task: int = ROWS_OF_TASK) -> DataFrame:
    """(s, o) of ``subjects(s)`` under a predicate, at most ``cap`` objects each in order."""
    if cap is not None:
        return _first_of_hop(triples, predicate, ["s"], "s", "o", cap, rows_of_task).join(subjects.select("s").hint("merge"), "s", "left_semi")
    return subjects.select("s").distinct().join(triples.filter(F.col("p") == PREDICATES[predicate]), "s").select("s", "o").distinct()


def subjects_of(objects: DataFrame, triples: DataFrame, predicate: str, cap: int | None = None, rows_of_task: int = ROWS_OF_TASK) -> DataFrame:
    """(s, o) of ``objects(o)`` under a predicate, at most ``cap`` subjects each in order. An object may have a great share of all
    subjects (a gene its groups), so tasks take the first of their own rows before they are put together."""
    if cap is not None:
        return _first_of_hop(triples, predicate, ["s", "o"], "o", "s", cap, rows_of_task).join(objects.select("o").hint("merge"), "o", "left_semi")
    return objects.select("o").distinct().join(triples.filter(F.col("p") == PREDICATES[predicate]), "o").select("s", "o").distinct()


#: Named hops: the predicate, whether seeds are its objects, and how many results a seed has by default.
HOPS = {
    "groups_of_participant": ("participant", True, None),
    "endpoints_of_group": ("output", False, None),
    "assays_of_group": ("assay_group", True, 5),
    "substance_of_endpoint": ("about", False, 1),
    "compound_of_substance": ("standardized", False, 1),
    "substances_of_compound": ("standardized", True, None),
    "groups_of_substance": ("participates", False, None),
}


def named_hop(name: str, seeds: DataFrame, triples: DataFrame, cap: int | None = None) -> DataFrame:
    """(seed, found) of ``seeds(seed)`` by one of HOPS: distinct, the first ones in order where a seed may have few."""
    predicate, inverse, most = HOPS[name]
    most = most if cap is None else cap
    if inverse:
        return subjects_of(seeds.select(F.col("seed").alias("o")), triples, predicate, most).select(F.col("o").alias("seed"), F.col("s").alias("found"))
    return objects_of(seeds.select(F.col("seed").alias("s")), triples, predicate, most).select(F.col("s").alias("seed"), F.col("o").alias("found"))


def described(subjects: DataFrame, triples: DataFrame, cap: int = 100) -> DataFrame:
    """All triples of the subjects, at most ``cap`` each."""
    return capped(triples.join(subjects.select("s").distinct(), "s", "left_semi"), ["s"], [F.col("p"), F.col("o")], cap)


def evidence_rows(triples: DataFrame, allowed: DataFrame | None = None, compounds: DataFrame | None = None, per_group: int | None = None) -> DataFrame:
    """The evidence star: group, measurement, substance, compound and target, joined over the triples, with the assay
    where there is one. ``allowed(mg, target)`` and ``compounds(compound)`` restrict it; at most ``per_group``
    measurements a group.

    Hops are shuffled by what they are joined by, and made distinct there: one exchange for both."""
    hop = lambda p, s, o, by: triples.filter(F.col("p") == PREDICATES[p]).select(F.col("s").alias(s), F.col("o").alias(o)).repartition(by).distinct()
    target = hop("participant", "mg", "target", "mg")
    if allowed is not None:
        target = target.join(allowed.select("mg", "target").distinct(), ["mg", "target"], "left_semi")
    outputs = hop("output", "mg", "endpoint", "endpoint" if per_group is None else "mg")
    if per_group is not None:
        outputs = capped(outputs, ["mg"], [F.col("endpoint")], per_group)
    standard = hop("standardized", "substance", "compound", "substance")
    if compounds is not None:
        standard = standard.join(compounds.select("compound").distinct(), "compound", "left_semi")
    found = outputs.join(hop("about", "endpoint", "substance", "endpoint"), "endpoint").join(standard, "substance").join(target, "mg")
    return found.join(hop("assay_group", "assay", "mg", "mg"), "mg", "left")


def genes_to_proteins(genes: DataFrame, triples: DataFrame) -> DataFrame:
    """Proteins of each gene, sorted, kept apart by gene."""
    found = subjects_of(genes.select(F.col("gene").alias("o")), triples, "encoded_by")
    return found.groupBy(F.col("o").alias("gene")).agg(F.array_sort(F.collect_set("s")).alias("proteins"))


def symbols_to_genes(symbols: DataFrame, triples: DataFrame, taxids: list[str]) -> DataFrame:
    """Genes of symbols whose organism is one of ``taxids``."""
    named = subjects_of(symbols.select(F.col("symbol").alias("o")), triples, "symbol")
    organism = triples.filter((F.col("p") == PREDICATES["organism"]) & F.col("o").isin(*taxids)).select("s").distinct()
    return named.join(organism, "s", "left_semi").select(F.col("o").alias("symbol"), F.col("s").alias("gene"))


def in_taxa(rows: DataFrame, key: str, organisms: DataFrame, taxids: list) -> DataFrame:
    """Rows whose organism is among ``taxids``, or that have none."""
    known = organisms.groupBy(key).agg(F.bool_or(F.col("taxid").isin(*taxids)).alias("_match"))
    return rows.join(known, key, "left").filter(F.coalesce("_match", F.lit(True))).drop("_match")


def known_or_missing(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Rows whose key is known or absent; only a key that is there and unknown rejects. Rows without a key aren't joined: an outer
    join would send all of them to one task."""
    columns = [key, *(c for c in rows.columns if c != key)]
    found = rows.filter(F.col(key).isNotNull()).join(known.select(key).distinct(), key, "left_semi")
    return found.select(*columns).unionByName(rows.filter(F.col(key).isNull()).select(*columns))


def entity_rows(evidence: DataFrame, kinds: dict[str, str], seq: str) -> DataFrame:
    """One row for each entity of the wide evidence rows (kind, id), where it first occurs."""
    made = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id")) for kind, c in kinds.items())))
    rows = evidence.select(seq, made.alias("e")).select("e.kind", "e.id", seq).filter("id is not null")
    return rows.groupBy("kind", "id").agg(F.min(seq).alias("first_seq"))


def filled(missing: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Missing ids with their full record where one is known, else a minimal row; ``retrieval_status`` tells which."""
    # Of several records of an id the first in order of all their columns.
    rest = [c for c in records.columns if c != key]
    marked = first_by(records.withColumn("_seq", F.to_json(F.struct(*rest))), [key], "_seq").withColumn("_full", F.lit(True))
    return missing.select(key).distinct().join(marked, key, "left").withColumn("retrieval_status", F.when(F.col("_full"), "full_record").otherwise("minimal_fallback")).drop("_full")


def kept_endpoints(endpoints: DataFrame, types: list[str] | None = None, numeric: bool = True) -> DataFrame:
    """Measurements of one of ``types`` (in any case; all if None) whose value is a number (if ``numeric``)."""
    kept = endpoints if types is None else endpoints.filter(F.lower("type").isin(*(x.lower() for x in types)))
    return kept.filter(F.col("value").cast("string").try_cast("double").isNotNull()) if numeric else kept

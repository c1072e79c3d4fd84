"""Co-occurrence resources of a triples table around targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written
from .graph import capped

# Prefixes of terms by what they name.
RESOURCE = "cooccurrence:"
ENDS = {"compound": "compound:", "protein": "protein:", "gene": "gene:", "disease": "disease:", "reference": "reference:"}
KEY = ["cooc_id", "compound", "protein", "gene", "disease", "reference"]


def _named(c: Column, prefix: str) -> Column:
    return c.startswith(prefix)


def resources_of(triples: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct (target, cooc) of resources that any predicate links to a target, in either direction."""
    wanted = targets.select("target").distinct()
    out = triples.filter(_named(F.col("s"), RESOURCE)).select(F.col("o").alias("target"), F.col("s").alias("cooc"))
    back = triples.filter(_named(F.col("o"), RESOURCE)).select(F.col("s").alias("target"), F.col("o").alias("cooc"))
    return out.unionByName(back).join(wanted, "target", "left_semi").distinct()


def cooccurrences(
    triples: DataFrame, targets: DataFrame, compounds: DataFrame | None = None, score: str = "score", sentences: str = "sentenceCount",
    per_target: int | None = None, per_pair: int | None = None, most: int | None = None,
) -> DataFrame:
    """Rows of the co-occurrence resources around ``targets(target)``: cooc_id, what else the resource is linked to under any predicate
    (compound, protein, gene, disease, reference; null where there is none), score and sentence_count by the predicates' local names, target
    and association_type.

    A resource with several ends of a kind gives a row for each combination. A target fills in its own column where that is
    empty. Each (cooc_id and ends) is there once, of the first target. Only if asked for, at most ``per_target`` rows a target, then
    ``per_pair`` references a pair of compound and protein (or gene, or target) count before that, and ``most`` rows after it; all in order of their
    terms. ``compounds(compound)`` keeps rows with one of these only. Only triples of resources that a target reaches are joined.

    Ends are lists of their resource until they are combined. Without caps of a target, targets are too: those that fill in nothing give
    the same rows, so only the first of them is combined with the ends, and nothing is shuffled after that.

    With a cap, each resource gives a target a row at least, and rows are in order of resources. So of a target's resources only the first
    ``per_target`` can count, and of these only those that the rows of earlier ones leave room for. The others go before anything is
    combined.
    """
    around = resources_of(triples, targets)
    kind = F.coalesce(*(F.when(_named(F.col("o"), prefix), name) for name, prefix in ENDS.items()))
    of_resources = triples.filter(_named(F.col("s"), RESOURCE)).select(F.col("s").alias("cooc"), "p", "o", kind.alias("kind"))
    if compounds is not None:
        listed = compounds.select(F.col("compound").alias("o")).distinct()
        chosen = of_resources.filter("kind = 'compound'").join(listed, "o", "left_semi").select("cooc", "p", "o", "kind")
        of_resources = of_resources.filter("kind is null or kind != 'compound'").unionByName(chosen)
        around = around.join(chosen.select("cooc").distinct(), "cooc", "left_semi")
    if per_target is not None:
        around = capped(around, ["target"], [F.col("cooc")], per_target)
    whole = per_target is None and per_pair is None
    if whole:
        around = around.groupBy("cooc").agg(F.collect_set("target").alias("targets"))
    # Read for the resources and for the rows, so it is written once.
    around = written(around.select("targets" if whole else "target", "cooc"), "resources")
    own = of_resources.join(around.select("cooc").distinct(), "cooc", "left_semi")
    if per_target is not None:
        # Rows of a resource are in order of its ends, so later ends than these are in later rows.
        place = F.dense_rank().over(Window.partitionBy("cooc", "kind").orderBy("o"))
        own = own.withColumn("_k", F.when(F.col("kind").isNull(), 0).otherwise(place)).filter(F.col("_k") <= per_target)
    local = F.regexp_extract("p", r"([^#/:]+)$", 1)
    number = lambda name: F.max(F.when(local == name, F.col("o").try_cast("double")))
    ends = own.groupBy("cooc").agg(*(F.collect_set(F.when(F.col("kind") == name, F.col("o"))).alias(name) for name in ENDS), number(score).alias("score"), number(sentences).alias("sentence_count"))
    rows = around.join(ends, "cooc", "left")
    if whole:
        empty = lambda name: F.size(F.coalesce(name, F.array())) == 0
        fills_in = lambda t: (_named(t, ENDS["protein"]) & empty("protein")) | (_named(t, ENDS["gene"]) & empty("gene"))
        others = F.array_min(F.filter("targets", lambda t: ~fills_in(t)))
        rows = rows.withColumn("target", F.explode(F.array_compact(F.array_append(F.filter("targets", fills_in), others))))
    if per_target is not None:
        made = F.lit(1.0)
        for name in ENDS:
            made = made * F.greatest(F.size(F.coalesce(name, F.array())), F.lit(1))
        earlier = Window.partitionBy("target").orderBy("cooc").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_n", made).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0.0))).filter(F.col("_before") < per_target)
    for name in ENDS:
        rows = rows.select(*(F.explode_outer(c).alias(c) if c == name else c for c in ("target", "cooc", *ENDS, "score", "sentence_count")))
    filled = lambda name: F.coalesce(F.col(name), F.when(_named(F.col("target"), ENDS[name]), F.col("target"))).alias(name)
    cooc_id = F.concat(F.lit("cooc:"), F.substring("cooc", len(RESOURCE) + 1, 1 << 30)).alias("cooc_id")
    # Ends of a resource are distinct and one that is filled in is the only one of its kind, so rows are distinct too.
    rows = rows.select("target", cooc_id, "compound", filled("protein"), filled("gene"), "disease", "reference", "score", "sentence_count")
    order = [F.col(c) for c in KEY]
    if per_target is not None:
        rows = capped(rows, ["target"], order, per_target)
    if per_pair is not None:
        pair = F.coalesce("protein", "gene", "target")
        cited = F.row_number().over(Window.partitionBy("target", "compound", pair).orderBy(F.col("reference").isNull(), *order))
        rows = rows.withColumn("_k", cited).filter(F.col("reference").isNull() | (F.col("_k") <= per_pair)).drop("_k")
    if not whole:
        once = F.row_number().over(Window.partitionBy(*KEY).orderBy("target"))
        rows = rows.withColumn("_k", once).filter("_k = 1").drop("_k")
    if most is not None:
        rows = rows.orderBy("target", *order).limit(most)
    both = F.col("compound").isNotNull() & F.coalesce("protein", "gene").isNotNull()
    return rows.withColumn("association_type", F.when(both, "compound-target cooccurrence").otherwise("entity cooccurrence"))

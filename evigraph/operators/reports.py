"""Reports as tables: counts, completeness, readiness and profiles, in long form (section, item, metric, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent

#: Caps that a complete run has none of.
CAPS = (
    "max_compounds_per_target", "max_targets_per_compound", "max_substances_per_compound", "max_measuregroups_per_target", "max_measuregroups_per_compound", "max_endpoints_per_pair",
    "max_similar_compounds_per_compound", "max_textmine_records", "max_textmine_records_per_target", "max_textmine_references_per_pair", "max_enrichment_records_per_entity",
)


def long_form(df: DataFrame, section: str, item: Column, metrics: dict[str, Column]) -> DataFrame:
    """section, item, metric and value of the columns of a small table."""
    entries = F.array(*(F.struct(F.lit(name).alias("metric"), c.cast("double").alias("value")) for name, c in metrics.items()))
    return df.select(F.lit(section).alias("section"), F.coalesce(item.cast("string"), F.lit("<missing>")).alias("item"), F.explode(entries).alias("e")).select("section", "item", "e.metric", "e.value")


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def counted(df: DataFrame, section: str, column: str) -> DataFrame:
    """How many rows each value of a column has, and their share in percent."""
    counts = df.groupBy(F.col(column).cast("string").alias("item")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return long_form(counts.crossJoin(F.broadcast(total)), section, F.col("item"), {"n": F.col("n"), "percent": percent(F.col("n"), F.col("total"))})


def crossed(df: DataFrame, section: str, first: str, second: str) -> DataFrame:
    """How many rows each pair of values has."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("<missing>"))
    counts = df.groupBy(text(first).alias("a"), text(second).alias("b")).agg(F.count("*").alias("n"))
    return long_form(counts, section, F.concat_ws("|", "a", "b"), {"n": F.col("n")})


def covered(df: DataFrame, section: str, columns: list[str]) -> DataFrame:
    """Of each column how many values are there, differ from zero, and the mean of the numbers, in one pass."""
    number = lambda c: F.col(c).cast("string").try_cast("double")
    there = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNotNull()
    row = df.agg(*(F.struct(F.count_if(there(c)).alias("n_present"), F.count_if(there(c) & (F.coalesce(number(c), F.lit(1.0)) != 0)).alias("n_nonzero"), F.count("*").alias("n_rows"), F.avg(number(c)).alias("mean")).alias(c) for c in columns))
    parts = [long_form(row.select(F.col(f"`{c}`.*")), section, F.lit(c), {m: F.col(m) for m in ("n_present", "n_nonzero", "n_rows", "mean")}) for c in columns]
    return together(*parts)


def columns_by_prefix(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """How many columns of a table begin with each prefix; the rest is ``other``. A table has a row for each prefix."""
    spark = df.sparkSession
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, df.columns))).alias("column"))
    prefix = F.coalesce(*(F.when(F.col("column").startswith(p), p) for p in prefixes), F.lit("other"))
    return names.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n_columns"))


def feature_completeness(compounds: DataFrame, structures: DataFrame, properties: DataFrame, representations: DataFrame, core: list[str]) -> DataFrame:
    """One row: compounds, and how many have a structure text, a core property, and a fingerprint; what misses them; and
    representations with and without one. Sides hold any number of rows a compound."""
    filled = lambda *names: F.coalesce(*(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in names)).isNotNull()
    texts = [c for c in ("smiles", "canonical_smiles", "isomeric_smiles") if c in structures.columns]
    known = compounds.select("cid").distinct()
    mark = lambda df, name: df.select("cid", F.lit(True).alias(name)).distinct()
    with_print = representations.filter("has_fingerprint")
    joined = known.join(mark(structures.filter(filled(*texts)), "s"), "cid", "left").join(mark(properties.filter(filled(*core)), "p"), "cid", "left").join(mark(with_print, "f"), "cid", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    counts = joined.agg(F.count("*").alias("compounds"), *(F.count_if(has(c)).alias(n) for c, n in (("s", "with_structure"), ("p", "with_core_properties"), ("f", "with_fingerprint"))), *(F.count_if(~has(c)).alias(n) for c, n in (("s", "missing_structure"), ("p", "missing_core_properties"), ("f", "missing_fingerprint"))))
    rows = representations.agg(F.count("*").alias("representations"), F.count_if("has_fingerprint").alias("representations_with_fingerprint"))
    return counts.crossJoin(F.broadcast(rows))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each layer's table."""
    return together(*(df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns")) for name, df in layers.items()))


def layer_diagnostics(records: DataFrame, statuses: list[str]) -> DataFrame:
    """Of each target: records, with and without a compound id, with a structure, distinct ligands, and how many have each
    of ``statuses``. ``records(target, cid, smiles, ligand_id, parse_status)``."""
    there = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNotNull()
    found = [F.count_if(F.col("parse_status") == s).alias(f"status_{s}") for s in statuses]
    return records.groupBy("target").agg(F.count("*").alias("n_records"), F.count_if(there("cid")).alias("n_with_id"), F.count_if(~there("cid")).alias("n_without_id"), F.count_if(there("smiles")).alias("n_with_structure"), F.count_distinct("ligand_id").alias("n_ligands"), *found)


def run_quality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: raw, unique and duplicate nodes and edges, and edges whose end is no node. ``nodes(node_ref)``,
    ``edges(type, start_ref, end_ref)``."""
    n = nodes.agg(F.count("*").alias("nodes_raw"), F.count_distinct("node_ref").alias("nodes_unique"))
    refs = nodes.select("node_ref").distinct()
    unique = edges.groupBy("type", "start_ref", "end_ref").agg(F.count("*").alias("n"))
    for side in ("start", "end"):
        unique = unique.join(refs.select(F.col("node_ref").alias(f"{side}_ref"), F.lit(True).alias(f"_{side}")), f"{side}_ref", "left")
    e = unique.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("edges_raw"), F.count("*").alias("edges_unique"), F.count_if(F.col("_start").isNull() | F.col("_end").isNull()).alias("edges_dangling"))
    joined = n.crossJoin(F.broadcast(e))
    return joined.withColumns({"nodes_duplicate": F.col("nodes_raw") - F.col("nodes_unique"), "edges_duplicate": F.col("edges_raw") - F.col("edges_unique")})


def merged_caps(manifests: DataFrame, caps: str = "caps", order: str = "turn") -> DataFrame:
    """One map of the caps of several manifests; of a cap that several name the last by ``order`` counts."""
    entries = manifests.select(F.explode(caps).alias("key", "value"), order).groupBy("key").agg(F.max_by("value", order).alias("value"))
    return entries.agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("caps"))


def cap_completeness(caps: DataFrame) -> DataFrame:
    """The caps that were active, and whether a run without any is complete: ``caps`` is a map of texts."""
    off = ("", "none", "None", "0")
    active = F.map_filter("caps", lambda k, v: k.isin(*CAPS) & v.isNotNull() & ~F.trim(v).isin(*off))
    return caps.select(active.alias("active_caps")).withColumn("status", F.when(F.size("active_caps") > 0, "capped_test_run").otherwise("uncapped_or_no_internal_caps_detected"))


def checked_derivation(interactions: DataFrame, numeric_endpoints: DataFrame) -> DataFrame:
    """``interactions`` as they are; an error when numeric measurements are there and not one interaction has a label."""
    found = interactions.agg(F.count("*").alias("n"), F.count_if(F.col("label").isin("curated_active", "curated_inactive", "curated_conflicting")).alias("labelled"))
    numeric = numeric_endpoints.limit(1).agg(F.count("*").alias("numeric"))
    failed = found.crossJoin(F.broadcast(numeric)).select(((F.col("numeric") > 0) & (F.col("n") > 0) & (F.col("labelled") == 0)).alias("_failed"))
    wrong = F.raise_error(F.lit("numeric measurements are there, but every interaction is without a label"))
    return interactions.crossJoin(F.broadcast(failed)).withColumn("label", F.when(F.col("_failed"), wrong.cast("string")).otherwise(F.col("label"))).drop("_failed")


def strictness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Of each column how many values are null, not a number, infinite or no number at all, in one pass."""
    def of(c):
        text = F.col(c).cast("string")
        value = text.try_cast("double")
        return F.struct(F.count_if(text.isNull()).alias("n_null"), F.count_if(F.isnan(value)).alias("n_nan"), F.count_if(F.abs(value) == float("inf")).alias("n_inf"), F.count_if(text.isNotNull() & value.isNull()).alias("n_text")).alias(c)

    row = df.agg(*map(of, columns))
    return together(*(row.select(F.lit(c).alias("feature"), F.col(f"`{c}`.*")) for c in columns)).withColumn("strict", F.col("n_null") + F.col("n_nan") + F.col("n_inf") + F.col("n_text") == 0)


def decision_summary(readiness: DataFrame, leakage: DataFrame, min_pairs: int = 100) -> DataFrame:
    """One row: the task that the labels allow, and the risks. ``readiness(target, n_positive, n_negative)``,
    ``leakage(risk)``."""
    n = readiness.agg(F.coalesce(F.sum("n_positive"), F.lit(0)).alias("positives"), F.coalesce(F.sum("n_negative"), F.lit(0)).alias("negatives"), F.count_if((F.col("n_positive") > 0) & (F.col("n_negative") > 0)).alias("two_class_targets"))
    r = leakage.agg(F.count_if(F.col("risk") == "high").alias("high_risks"), F.count_if(F.col("risk") == "warning").alias("warnings"))
    task = (
        F.when(F.col("positives") + F.col("negatives") < min_pairs, "not_enough_labels")
        .when(F.col("negatives") == 0, "link_prediction_with_unlabelled_candidates")
        .when(F.col("two_class_targets") == 0, "ranking_per_target")
        .otherwise("binary_classification")
    )
    risks = F.array_compact(F.array(F.when(F.col("high_risks") > 0, "split_leakage"), F.when(10 * F.least("positives", "negatives") < F.greatest("positives", "negatives"), "class_imbalance"), F.when(F.col("two_class_targets") == 0, "one_class_targets")))
    return n.crossJoin(F.broadcast(r)).select("*", task.alias("task"), F.array_join(risks, ";").alias("risks"))


def external_evidence(layers: dict[str, DataFrame], affinities: DataFrame | None = None, target: str = "protein_id", kind: str = "affinity_type") -> DataFrame:
    """Rows and columns of each evidence layer, and the affinity records of each target and type, in long form."""
    sizes = [long_form(df.agg(F.count("*").alias("n")), "layer", F.lit(name), {"rows": F.col("n"), "columns": F.lit(len(df.columns))}) for name, df in layers.items()]
    if affinities is not None:
        each = lambda section, c: long_form(affinities.groupBy(F.col(c).cast("string").alias("item")).agg(F.count("*").alias("n")), section, F.col("item"), {"n": F.col("n")})
        sizes += [each("affinities_by_target", target), each("affinities_by_type", kind)]
    return together(*sizes)


def pair_modeling(pairs: DataFrame, label: str, target: str, split: str, evidence: list[str], categories: list[str] = ()) -> DataFrame:
    """Pairs by split, target and label, coverage of the evidence columns and their means by label (missing as 0), and counts of categories,
    in long form."""
    by_label = pairs.groupBy(F.coalesce(F.col(label).cast("string"), F.lit("<missing>")).alias("item")).agg(F.count("*").alias("rows"), *(F.avg(F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0))).alias(f"m_{i}") for i, c in enumerate(evidence)))
    means = long_form(by_label, "mean_by_label", F.col("item"), {"rows": F.col("rows")} | {c: F.col(f"m_{i}") for i, c in enumerate(evidence)})
    tables = [crossed(pairs, "split_by_label", split, label), crossed(pairs, "target_by_label", target, label), crossed(pairs, "target_by_split", target, split), means]
    tables += [covered(pairs, "coverage", evidence)] if evidence else []
    return together(*tables, *(counted(pairs, c, c) for c in categories))


#: Pair features that a model should have, of which four at least must be there.
PAIR_FEATURES = ("assay_count", "reference_count", "evidence_count", "bindingdb_has_record", "textmine_confidence_score", "best_negative_log10_molar", "best_value_um")


def preparation_checklist(pairs: DataFrame, nodes: DataFrame, edges: DataFrame, train_edges: DataFrame, status: str | None = None, tensors: bool = False) -> DataFrame:
    """item, status (pass, review or fail) and detail of what modeling needs: a readiness ``status``, pairs with two labels and a known split,
    node ids, edges, a train-only graph, tensors, and pair features. Each table is counted once."""
    has = lambda c: c in pairs.columns
    names = lambda c: F.array_sort(F.collect_set(F.col(c).cast("string"))) if has(c) else F.array().cast("array<string>")
    # Labels and splits have few values.
    one = pairs.agg(F.count("*").alias("pairs"), names("label").alias("labels"), names("split").alias("splits"))
    for name, df in (("nodes", nodes), ("edges", edges), ("train", train_edges)):
        one = one.crossJoin(F.broadcast(df.agg(F.count("*").alias(name))))
    there = [c for c in PAIR_FEATURES if has(c)]
    rows = lambda c: F.concat(F.lit("rows="), F.col(c).cast("string"))
    listed = lambda c: F.concat(F.lit(f"{c}="), F.array_join(c, ","))
    rule = lambda good, other: F.when(good, "pass").otherwise(other)
    checks = [("readiness", rule(F.lit(status in ("ready", "gcn_modeling_ready")), "review"), F.lit(f"status={status}")), ("pair_table", rule(F.col("pairs") > 0, "fail"), rows("pairs"))]
    if has("label"):
        checks.append(("pair_labels", rule((F.col("pairs") == 0) | (F.size("labels") > 1), "review"), listed("labels")))
    if has("split"):
        checks.append(("split", rule((F.col("pairs") == 0) | F.arrays_overlap("splits", F.array(*map(F.lit, ("train", "val", "test")))), "review"), listed("splits")))
    checks += [("node_ids", rule(F.col("nodes") > 0, "fail"), rows("nodes")), ("edges", rule(F.col("edges") > 0, "fail"), rows("edges")), ("train_only_edges", rule(F.col("train") > 0, "review"), rows("train"))]
    checks += [("tensors", rule(F.lit(tensors), "review"), F.lit(f"written={str(tensors).lower()}")), ("pair_features", rule(F.lit(len(there) >= 4), "review"), F.lit("present=" + ",".join(there)))]
    entries = F.array(*(F.struct(F.lit(item).alias("item"), state.alias("status"), detail.alias("detail")) for item, state, detail in checks))
    return one.select(F.explode(entries).alias("c")).select("c.*")

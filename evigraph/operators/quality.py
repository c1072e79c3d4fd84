"""Profiles and audits of tables: counts, risks and recommendations as rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import dense_ids

MISSING = "<missing>"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value, blanks as one, with percent. The total is a second aggregation of the counts."""
    value = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit(MISSING))
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.join(F.broadcast(total)).withColumn("percent", F.round(100 * F.col("n") / F.col("_total"), 3)).drop("_total")


def cross_counts(df: DataFrame, a: str, b: str, values: list[str]) -> DataFrame:
    """Rows of each value of ``a`` by the listed values of ``b``, as columns."""
    return df.groupBy(a).agg(*(F.count_if(F.col(b) == v).alias(f"n_{v}") for v in values))


def set_counts(df: DataFrame, label: str, split: str, protein: str) -> DataFrame:
    """Counts by label, by split and label, and by protein and label: grouping sets in one pass. ``level`` names the set."""
    df = df.select(F.col(label).alias("label"), F.col(split).alias("split"), F.col(protein).alias("protein"))
    sets = df.groupingSets([["label"], ["split", "label"], ["protein", "label"]], "label", "split", "protein")
    counts = sets.agg(F.count("*").alias("n"), F.grouping("split").alias("_s"), F.grouping("protein").alias("_p"))
    level = F.when(F.col("_s") == 0, "split").when(F.col("_p") == 0, "protein").otherwise("all")
    return counts.withColumn("level", level).drop("_s", "_p")


def label_name(c: Column) -> Column:
    """positive, negative, unknown or other."""
    text = F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    return (
        F.when(text.isin("1", "1.0", "true", "positive", "active"), "positive")
        .when(text.isin("0", "0.0", "false", "negative", "inactive"), "negative")
        .when(text.isin("", "nan", "none", "null", "unknown", "unlabeled", "candidate"), "unknown")
        .otherwise("other")
    )


def risk(value: Column, warning: float, high: float) -> Column:
    """high from ``high`` on, warning from ``warning`` on, else low; unknown for null."""
    return F.when(value.isNull(), "unknown").when(value >= high, "high").when(value >= warning, "warning").otherwise("low")


def target_readiness(pairs: DataFrame, target: str, label: str, split: str) -> DataFrame:
    """Positives, negatives and unknowns of each target, overall and by split, their ratio, and the risk that follows."""
    name = label_name(F.col(label))
    splits = ("train", "val", "test")
    found = pairs.groupBy(target).agg(
        F.count_if(name == "positive").alias("n_positive"),
        F.count_if(name == "negative").alias("n_negative"),
        F.count_if(name == "unknown").alias("n_unknown"),
        F.count("*").alias("n_pairs"),
        *(F.count_if((F.col(split) == s) & (name != "unknown")).alias(f"n_{s}") for s in splits),
    )
    found = found.withColumns({"ratio": F.col("n_positive") / F.nullif(F.col("n_negative"), F.lit(0)), "percent_unknown": F.round(100 * F.col("n_unknown") / F.col("n_pairs"), 3)})
    few = (F.col("n_negative") < 50) | (F.col("n_positive") < 100)
    uneven = (F.col("percent_unknown") > 90) | ~F.col("ratio").between(0.1, 10)
    return found.withColumn("risk", F.when(few, "high_risk").when(F.coalesce(uneven, F.lit(True)), "review").otherwise("ready"))


def split_overlap(pairs: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that two splits share, in number and as percent of the smaller one, for each pair of splits; splits are few,
    so a key's splits are gathered as a short array."""
    sets = pairs.select(key, split).distinct()
    sizes = sets.groupBy(split).agg(F.count("*").alias("n"))
    held = sets.groupBy(key).agg(F.array_sort(F.collect_list(split)).alias("s")).filter(F.size("s") > 1)
    both = held.select(F.explode(F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p"))
    shared = both.groupBy("p.a", "p.b").agg(F.count("*").alias("n_shared"))
    a, b = (sizes.select(F.col(split).alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b"))
    pairs_of = a.join(b, F.col("a") < F.col("b")).join(shared, ["a", "b"], "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))
    share = F.round(100 * F.col("n_shared") / F.least("n_a", "n_b"), 3)
    return pairs_of.withColumn("percent_shared", share).withColumn("risk", risk(share, 0.001, 5))


def split_audit(pairs: DataFrame, key: str, split: str, label: str, edge_sets: dict[str, DataFrame]) -> DataFrame:
    """Checks of a split as rows (check_name, status, detail): the balance of labels in each split (review from five positives a negative on,
    high-risk from fifteen, and without a negative), the ``key`` values that two splits share (high-risk if any), and whether ``edge_sets``
    have a ``train_only`` set that is no larger than ``full``. A null split is one of its own, called ``null``."""
    named = pairs.select(F.coalesce(F.col(split).cast("string"), F.lit("null")).alias("s"), F.col(key).alias("k"), label_name(F.col(label)).alias("l"))
    n = lambda name: F.count_if(F.col("l") == name).alias(name)
    counts = named.groupBy("s").agg(n("positive"), n("negative"), n("unknown"), F.count("*").alias("total"))
    ratio = F.col("positive") / F.nullif(F.col("negative"), F.lit(0))
    only = (F.col("negative") == 0) & (F.col("positive") > 0)
    status = F.when(only | (ratio >= 15), "high-risk").when(ratio >= 5, "review").otherwise("pass")
    detail = F.concat(*(part for name in ("positive", "negative", "unknown", "total") for part in (F.lit(f"{name}="), F.col(name).cast("string"), F.lit("; "))))
    balance = counts.select(F.concat(F.lit("label_balance_"), "s").alias("check_name"), status.alias("status"), F.rtrim(detail, F.lit("; ")).alias("detail"))
    shared = split_overlap(named.filter("k is not null"), "k", "s")
    overlap = shared.select(F.concat(F.lit("overlap_"), "a", F.lit("_vs_"), "b").alias("check_name"), F.when(F.col("n_shared") > 0, "high-risk").otherwise("pass").alias("status"), F.concat(F.lit("shared="), F.col("n_shared").cast("string")).alias("detail"))
    sizes = None
    for name in ("full", "train_only", "holdout_removed"):
        one = edge_sets[name].agg(F.count("*").alias("n")) if name in edge_sets else pairs.sparkSession.range(1).select(F.lit(0).cast("long").alias("n"))
        one = one.select(F.lit(name).alias("name"), "n")
        sizes = one if sizes is None else sizes.unionByName(one)
    wide = sizes.agg(*(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in ("full", "train_only", "holdout_removed")))
    good = (F.col("train_only") > 0) & (F.col("train_only") <= F.greatest("full", F.lit(1)))
    detail = F.concat(F.lit("full="), F.col("full").cast("string"), F.lit("; train_only="), F.col("train_only").cast("string"), F.lit("; holdout_removed="), F.col("holdout_removed").cast("string"))
    edges = wide.select(F.lit("train_only_edges").alias("check_name"), F.when(good, "pass").otherwise("review").alias("status"), detail.alias("detail"))
    return balance.unionByName(overlap).unionByName(edges)


def with_presence(pairs: DataFrame, key: str, described: DataFrame, name: str = "has_descriptors") -> DataFrame:
    """``pairs`` with whether their ``key`` is described."""
    found = described.select(key).distinct().withColumn(name, F.lit(True))
    return pairs.join(found, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def endpoint_audit(endpoints: DataFrame) -> DataFrame:
    """Measurements that fall under each rule, with percent; one aggregation, then one row a rule."""
    rules = {
        "missing_type": F.col("endpoint_type").isNull(),
        "missing_value": ~F.col("has_numeric_value"),
        "missing_unit": F.col("normalization_status") == "missing_unit",
        "unsupported_unit": F.col("normalization_status") == "unsupported_unit",
        "nonpositive_value": F.col("normalization_status") == "nonpositive_value",
        "one_sided_interval": F.col("value_lower_molar").isNull() != F.col("value_upper_molar").isNull(),
        "implausibly_potent": F.col("value_molar") < 1e-13,
        "implausibly_weak": F.col("value_molar") > 1,
        "not_eligible": ~F.col("threshold_label_eligible"),
        "unlabelled": F.col("label").isNull(),
        "conflicting": F.col("label_reliability") == "conflicting",
    }
    counts = endpoints.agg(F.count("*").alias("n_rows"), *(F.count_if(rule).alias(name) for name, rule in rules.items()))
    rows = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(name).alias("n")) for name in rules))
    return counts.select("n_rows", F.explode(rows).alias("r")).select("r.rule", "r.n", F.round(100 * F.col("r.n") / F.col("n_rows"), 3).alias("percent"))


def leakage_audit(df: DataFrame, columns: list[str], identifier) -> DataFrame:
    """Distinct share of each column's values; columns named like identifiers or nearly unique are a risk."""
    wide = df.agg(*(F.count_distinct(F.col(c)).alias(f"d_{i}") for i, c in enumerate(columns)), *(F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"n_{i}").alias("n_present"), F.col(f"d_{i}").alias("n_distinct"), F.lit(identifier(c)).alias("identifier_like")) for i, c in enumerate(columns)))
    found = wide.select(F.explode(rows).alias("r")).select("r.*").withColumn("unique_ratio", F.col("n_distinct") / F.nullif(F.col("n_present"), F.lit(0)))
    return found.withColumn("risk", F.when(F.col("identifier_like"), "high").otherwise(risk(F.col("unique_ratio"), 0.9, 0.98)))


def recommendation(missing: Column, zero: Column, unique: Column, identifier: Column) -> Column:
    """What to do with a feature, the first rule that holds."""
    return (
        F.when(identifier, "drop_identifier")
        .when(missing >= 95, "drop_missing")
        .when(zero >= 99.5, "review_sparse")
        .when(unique >= 0.98, "review_near_unique")
        .when(missing >= 50, "keep_with_indicator")
        .otherwise("keep")
    )


def candidate_space(pairs: DataFrame, candidates: DataFrame, target: str) -> DataFrame:
    """Known positives and candidates of each target, and how many candidates there are for each positive; ``candidates``
    are pairs, or counts of them by target (n_candidates)."""
    known = pairs.groupBy(target).agg(F.count_if(F.col("label") == 1).alias("n_positive"))
    space = candidates if "n_candidates" in candidates.columns else candidates.groupBy(target).agg(F.count("*").alias("n_candidates"))
    return rated_space(known.join(space, target, "full").na.fill(0, ["n_positive", "n_candidates"]))


def rated_space(both: DataFrame) -> DataFrame:
    """``candidate_space`` of counts by target (n_positive, n_candidates)."""
    per = F.col("n_candidates") / F.nullif(F.col("n_positive"), F.lit(0))
    return both.withColumn("candidates_per_positive", per).withColumn("status", F.when(F.col("n_positive") == 0, "no_positive").when(per > 1000, "very_sparse").otherwise("rankable"))


def readiness(counts: dict[str, Column], required: dict[str, int], advised: dict[str, int]) -> tuple[Column, Column, Column]:
    """Blockers, warnings and the status that follows, from counts and the least that is required or advised."""
    blockers = F.array_compact(F.array(*(F.when(counts[k] < n, f"too_few_{k}") for k, n in required.items())))
    warnings = F.array_compact(F.array(*(F.when(counts[k] < n, f"few_{k}") for k, n in advised.items())))
    return blockers, warnings, F.when(F.size(blockers) > 0, "blocked").when(F.size(warnings) > 0, "ready_with_warnings").otherwise("ready")


def table_hash(df: DataFrame, order: list[str], block: int = 4096) -> DataFrame:
    """An ordered content hash of a table: content_sha256 and n_rows.

    A row is its columns by name as ``name=length:value`` (``name=~`` for null), joined by ``|``; its hash is the SHA-256 of
    that. Rows are numbered in ``order``, which must tell all apart; hashes of ``block`` rows in a row are joined and hashed,
    then those of ``block`` such blocks, and so on until one is left. No task holds more than a block. An empty table gives no
    row.
    """
    text = lambda c: F.col(f"`{c}`").cast("string")
    cell = lambda c: F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("~")))
    level = dense_ids(df, order, "_i").select("_i", F.sha2(F.concat_ws("|", *map(cell, sorted(df.columns))), 256).alias("h"))
    rows = n = df.count()
    while n > 1 or rows == n:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("_i", "h"))), lambda x: x["h"])
        level = level.groupBy(F.floor(F.col("_i") / block).alias("_b")).agg(F.sha2(F.array_join(ordered, ""), 256).alias("h")).withColumnRenamed("_b", "_i")
        if n <= block:
            break
        n = -(-n // block)
    return level.select(F.col("h").alias("content_sha256"), F.lit(rows).cast("long").alias("n_rows"))


def missing_fractions(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of missing or blank values of each column, most first."""
    blank = lambda c: (F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`").cast("string")) == "")).cast("double")
    wide = df.agg(*(F.avg(blank(c)).alias(f"m_{i}") for i, c in enumerate(columns)))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("missing_fraction")) for i, c in enumerate(columns)))
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def similarity_quality(edges: DataFrame, nodes: DataFrame, asserted: DataFrame) -> DataFrame:
    """Similarity edges in all, with both ends known, dangling; distinct missing ends; nodes that only similarity names.

    ``edges(a, b)``, ``nodes(id)``, ``asserted(id)``."""
    known = nodes.select("id").distinct()
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    missing = ends.join(known, "id", "left_anti")
    only = ends.join(known, "id", "left_semi").join(asserted.select("id").distinct(), "id", "left_anti")
    flagged = edges.join(known.select(F.col("id").alias("a"), F.lit(1).alias("_a")), "a", "left").join(known.select(F.col("id").alias("b"), F.lit(1).alias("_b")), "b", "left")
    counts = flagged.agg(F.count("*").alias("n_edges"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_valid"))
    # One row each.
    one = counts.join(F.broadcast(missing.agg(F.count("*").alias("n_missing_ids")))).join(F.broadcast(only.agg(F.count("*").alias("n_similarity_only"))))
    return one.withColumn("n_dangling", F.col("n_edges") - F.col("n_valid"))


def layer_status(layers: dict[str, DataFrame], requested: list[str]) -> DataFrame:
    """Rows of each optional layer and what that says of it; one count a layer."""
    out = None
    for name, rows in layers.items():
        one = rows.agg(F.count("*").alias("n_rows")).withColumn("layer", F.lit(name))
        out = one if out is None else out.unionByName(one)
    asked = F.col("layer").isin(*requested) if requested else F.lit(False)
    status = F.when(F.col("n_rows") > 0, "materialized").when(asked, "requested_but_empty").otherwise("not_requested")
    return out.withColumn("status", status)


def annotation_sets(edges: DataFrame, key: str, relation: str, ref: str, relations: list[str], cap: int = 100) -> DataFrame:
    """Distinct annotations of each key by relation, and the first ``cap`` of them in order; rows are made distinct and
    cut before lists are gathered."""
    from .graph import capped

    once = edges.select(key, relation, ref).distinct()
    counts = once.groupBy(key).agg(*(F.count_if(F.col(relation) == r).alias(f"n_{r}") for r in relations))
    first = capped(once, [key, relation], [F.col(ref)], cap)
    lists = first.groupBy(key).agg(*(F.array_sort(F.collect_list(F.when(F.col(relation) == r, F.col(ref)))).alias(f"refs_{r}") for r in relations))
    return counts.join(lists, key)

"""From labelled measurements to compound-protein pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.endpoint import LABELLED_TYPES, assertion
from ..sources.shared import written

PAIR = ["cid", "protein_id"]
#: What pairs are made of.
MEASURED = ["endpoint_id", "mg_id", "sid", "endpoint_type", "value_molar", "label", "reference_id"]
#: Measurements that one task fans out to the proteins of their groups.
ROWS_OF_TASK = 100_000


def last_by(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """The last value of each key by ``seq``."""
    return df.groupBy(key).agg(F.max_by(value, seq).alias(value))


def evidence_paths(endpoints: DataFrame, substances: DataFrame, tested_on: DataFrame) -> DataFrame:
    """Every (compound, protein, measurement) along compound - substance - measurement - group - protein.

    All matches count. Equal measurements are one before the fan-out to the proteins of their group; measurements that
    share an id and differ in what is measured stay apart.
    """
    # One exchange for what is made distinct and joined.
    once = endpoints.select(*(c for c in MEASURED if c in endpoints.columns)).repartition("sid").distinct()
    return once.join(substances, "sid").join(tested_on, "mg_id")


def _dealt(rows: DataFrame, measurements: int, rows_of_task: int) -> DataFrame:
    """``rows`` by compound, in tasks that grow in number with the measurements and that Spark doesn't lower: it goes by what is
    shuffled, which is before the rows fan out."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-measurements // rows_of_task))
    return rows.repartition(tasks, "cid")


def _with_proteins(rows: DataFrame, substances: DataFrame, tested_on: DataFrame) -> DataFrame:
    """``rows(mg_id, sid, ...)`` with the compounds of their substance, a row each, and the proteins of their group, as an array. What is
    joined grows with the measurements, so nothing is broadcast."""
    of_groups = tested_on.select("mg_id", "protein_id").filter("mg_id is not null").repartition("mg_id").groupBy("mg_id").agg(F.collect_set("protein_id").alias("_set"), F.bool_or(F.col("protein_id").isNull()).alias("_none"))
    none = F.array(F.lit(None).cast(tested_on.schema["protein_id"].dataType))
    of_groups = of_groups.select("mg_id", F.when(F.col("_none"), F.concat("_set", none)).otherwise(F.col("_set")).alias("_proteins"))
    return rows.join(substances.hint("merge"), "sid").join(of_groups.hint("merge"), "mg_id")


def _fanned_out(rows: DataFrame) -> DataFrame:
    return rows.select(*(c for c in rows.columns if c != "_proteins"), F.explode("_proteins").alias("protein_id"))


def paths_by_compound(endpoints: DataFrame, substances: DataFrame, tested_on: DataFrame, rows_of_task: int = ROWS_OF_TASK) -> DataFrame:
    """``evidence_paths``, dealt to tasks by compound: what is made of pairs or compounds needs no further shuffle.

    Paths are several times the measurements, so measurements are shuffled with the proteins of their group in an array, and fan out
    in the task that aggregates them. ``tested_on`` may have rows repeatedly."""
    once = endpoints.select(*(c for c in MEASURED if c in endpoints.columns)).repartition("sid").distinct()
    return _fanned_out(_dealt(_with_proteins(once, substances, tested_on), endpoints.count(), rows_of_task))


def _cited(references: DataFrame) -> DataFrame:
    """How many rows cite a measurement, and its distinct references."""
    return references.groupBy("endpoint_id").agg(F.count("*").alias("_times"), F.collect_set("reference_id").alias("_references"))


def interaction_support(paths: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """Distinct measurements, groups, substances and (with ``references(endpoint_id, reference_id)``) references of each
    pair, its label counts, and the assertion that they make. Labels count once for each row that cites a measurement, and
    once where none does."""
    rows = paths.select(*PAIR, "endpoint_id", "mg_id", "sid", "label")
    if references is not None:
        rows = rows.join(_cited(references), "endpoint_id", "left")
    return _support(rows.withColumn("_alone", F.lit(False)).repartition(*PAIR), references is not None)


def interaction_support_by_compound(endpoints: DataFrame, substances: DataFrame, tested_on: DataFrame, references: DataFrame, rows_of_task: int = ROWS_OF_TASK) -> DataFrame:
    """``interaction_support`` of the paths of ``endpoints``. Measurements get their references before they fan out, and go to the task of their
    compound with these and with the proteins of their group. Ids that one measurement only has are not shuffled further: such rows count
    by themselves."""
    once = endpoints.select(*(c for c in MEASURED if c in endpoints.columns)).repartition("endpoint_id").distinct()
    rows = once.join(_cited(references).hint("merge"), "endpoint_id", "left").withColumn("_n", F.count("*").over(Window.partitionBy("endpoint_id")))
    shared = F.when(F.col("_n") > 1, F.col("endpoint_id")).alias("endpoint_id")
    rows = rows.select("mg_id", "sid", "label", shared, ((F.col("_n") == 1) & F.col("endpoint_id").isNotNull()).alias("_alone"), "_times", "_references")
    return _support(_fanned_out(_dealt(_with_proteins(rows, substances, tested_on), endpoints.count(), rows_of_task)), True)


def _support(rows: DataFrame, cited: bool) -> DataFrame:
    """``interaction_support`` of paths that lie in the task of their pair; those that are ``_alone`` count as a measurement each, the others by
    their ids.

    Several distinct counts of one aggregation repeat each row for each of them. Here the ranks of a pair's sorted values
    count them, in memory that does not grow with the pair. References, the widest fan-out, come last."""
    # Nulls sort first and count as none.
    rank = lambda c: F.dense_rank().over(Window.partitionBy(*PAIR).orderBy(c))
    number = lambda n, c: (F.max(f"_{n}") - F.max(F.col(c).isNull().cast("int"))).cast("long")
    ranked = {"n_endpoints": "endpoint_id", "n_groups": "mg_id", "n_substances": "sid"}
    counted, first, times = rows.withColumns({f"_{n}": rank(c) for n, c in ranked.items()}), F.lit(True), F.lit(1)
    if cited:
        counted = counted.select("*", F.posexplode_outer("_references").alias("_at", "_reference")).withColumn("_n_references", rank("_reference"))
        # A path is several rows here, of which the first counts for it.
        first, times = F.coalesce("_at", F.lit(0)) == 0, F.coalesce("_times", F.lit(1))
    labelled = lambda is_so: F.sum(F.when(first & is_so, times).otherwise(0))
    per_pair = counted.groupBy(*PAIR).agg(
        (F.count_if(first & F.col("_alone")) + number("n_endpoints", "endpoint_id")).alias("n_endpoints"),
        number("n_groups", "mg_id").alias("n_groups"),
        number("n_substances", "sid").alias("n_substances"),
        labelled(F.col("label") == 1).alias("n_positive"),
        labelled(F.col("label") == 0).alias("n_negative"),
        labelled(F.col("label").isNull()).alias("n_unclear"),
        *([number("n_references", "_reference").alias("n_references")] if cited else []),
    )
    decided = per_pair.withColumn("_a", assertion(F.col("n_positive"), F.col("n_negative"), F.col("n_unclear")))
    return decided.withColumns({"assertion": F.col("_a.assertion"), "confidence": F.col("_a.confidence")}).drop("_a")


def pair_label(positive: Column, negative: Column) -> Column:
    """1 with positive evidence only, 0 with negative only, null with both or none."""
    return F.when((positive > 0) & (negative == 0), 1).when((negative > 0) & (positive == 0), 0)


def endpoint_features(paths: DataFrame) -> DataFrame:
    """Potency and count features of each pair's distinct measurements, with the pair's label.

    One aggregation: the smallest value a type and the counts a type are conditional aggregates.
    """
    micro = F.col("value_molar") * 1e6
    types = {t: F.col("endpoint_type") == t for t in LABELLED_TYPES}
    found = paths.groupBy(*PAIR).agg(
        F.count("*").alias("n_endpoints"),
        F.min("value_molar").alias("min_value_molar"),
        F.min(micro).alias("min_value_um"),
        F.max(-F.log10("value_molar")).alias("max_negative_log10_molar"),
        *(F.min(F.when(is_type, micro)).alias(f"min_{t.lower()}_um") for t, is_type in types.items()),
        *(F.count_if(is_type).alias(f"n_{t.lower()}") for t, is_type in types.items()),
        F.count_if(F.col("label") == 1).alias("n_active"),
        F.count_if(F.col("label") == 0).alias("n_weak"),
        F.count_if(F.col("label").isNull()).alias("n_unlabelled"),
    )
    counts = F.array(*(F.when(F.col(f"n_{t.lower()}") > 0, F.concat(F.lit(f"{t}="), F.col(f"n_{t.lower()}").cast("string"))) for t in sorted(types)))
    return found.withColumns({"endpoint_types": F.array_join(F.array_compact(counts), ";"), "label": pair_label(F.col("n_active"), F.col("n_weak"))})


def training_pairs(features: DataFrame) -> DataFrame:
    """Pairs with a label, and where the negatives come from."""
    source = F.when(F.col("label") == 0, "weak_or_declared_inactive_measurement")
    return features.filter("label is not null").withColumn("negative_source", source)


def weighted_scores(rows: DataFrame, min_support: int = 1, model: str = "weighted_mean") -> DataFrame:
    """The weighted share of active measurements of each pair with at least ``min_support`` rows; 0 without weight."""
    active = F.when(F.col("activity") != 0, F.lit(1.0)).otherwise(F.lit(0.0))
    weight = F.coalesce(F.col("w"), F.lit(1.0))
    found = rows.filter("cid is not null and protein_id is not null").groupBy(*PAIR).agg(
        F.count("*").alias("support"),
        F.sum(active * weight).alias("_num"),
        F.sum(weight).alias("_den"),
        F.array_sort(F.collect_list("endpoint_id")).alias("evidence"),
    )
    score = F.coalesce(F.col("_num") / F.nullif(F.col("_den"), F.lit(0.0)), F.lit(0.0))
    return found.filter(F.col("support") >= min_support).select(*PAIR, "support", score.alias("score"), F.lit(model).alias("model"), "evidence")


def binding_features(records: DataFrame) -> DataFrame:
    """Records of each pair with the best value and its type (Kd before Ki before IC50 on ties) and the least of each.

    ``records(cid, protein_id, record_id, kd, ki, ic50)``, in nM.
    """
    kinds = ("kd", "ki", "ic50")
    each = F.explode(F.array(*(F.struct(F.col(k).alias("value"), F.lit(i).alias("rank")) for i, k in enumerate(kinds))))
    best = records.select(*PAIR, each.alias("c")).filter("c.value is not null").groupBy(*PAIR).agg(F.min("c").alias("c"))
    names = F.when(F.col("c.rank") == 0, "Kd").when(F.col("c.rank") == 1, "Ki").otherwise("IC50")
    counts = records.groupBy(*PAIR).agg(F.count_distinct("record_id").alias("n_records"), *(F.min(k).alias(f"min_{k}") for k in kinds))
    return counts.join(best.select(*PAIR, F.col("c.value").alias("best_value"), names.alias("best_type")), PAIR, "left")


def comention_features(mentions: DataFrame) -> DataFrame:
    """Distinct co-mentions and references of each pair, the highest and mean score (0.25 where none is given), and a
    confidence that grows with counts up to ten, in bands."""
    score = F.coalesce("score", F.lit(0.25))
    found = mentions.groupBy(*PAIR).agg(F.count_distinct("mention_id").alias("n_mentions"), F.count_distinct("reference_id").alias("n_references"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score"))
    sure = F.least(F.lit(1.0), F.col("max_score") + 0.03 * F.least("n_mentions", F.lit(10)) + 0.02 * F.least("n_references", F.lit(10)))
    band = F.when(F.col("confidence") >= 0.75, "high").when(F.col("confidence") >= 0.45, "medium").otherwise("low")
    return found.withColumn("confidence", sure).withColumn("confidence_band", band)


def with_defaults(pairs: DataFrame, features: DataFrame, defaults: dict) -> DataFrame:
    """Pairs with their features, defaults where they have none."""
    joined = pairs.join(features, PAIR, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})


def endpoint_context(endpoints: DataFrame, groups: DataFrame, references: DataFrame) -> DataFrame:
    """Distinct groups, assays and references of each measurement."""
    placed = endpoints.select("endpoint_id", "mg_id").join(groups, "mg_id", "left").groupBy("endpoint_id").agg(F.count_distinct("mg_id").alias("n_groups"), F.count_distinct("aid").alias("n_assays"))
    cited = references.groupBy("endpoint_id").agg(F.count_distinct("reference_id").alias("n_references"))
    return placed.join(cited, "endpoint_id", "left").withColumn("n_references", F.coalesce("n_references", F.lit(0)))


#: Proteins that follow each other for a compound; compounds that one task makes pairs of.
RUN, COMPOUNDS_OF_TASK = 128, 2000


def _runs(proteins: DataFrame, broadcast_rows: int) -> tuple[int, Column]:
    """How many blocks of proteins there are, and the run of a protein."""
    n = proteins.count()
    blocks = -(-n // broadcast_rows) or 1
    return blocks, F.pmod(F.xxhash64("protein_id"), F.lit(max(blocks, -(-n // RUN)))).cast("int")


def _product(rows: DataFrame, proteins: DataFrame, broadcast_rows: int, known: str | None = None) -> DataFrame:
    """``rows(cid, ...)`` with each ``protein_id`` of ``proteins``, which are distinct, and the other columns of its row as ``_protein``;
    ``known`` is a column of proteins by run, which are left out.

    Proteins go in runs of about RUN, and a task takes one run for all its compounds before the next. So the same ids repeat within a short
    distance, and a file of the pairs is a small part of what it would be otherwise. Runs of ``broadcast_rows`` proteins at most are broadcast
    at once, after a count; the product is neither shuffled nor written."""
    blocks, run = _runs(proteins, broadcast_rows)
    of_runs = proteins.groupBy(run.alias("_run")).agg(F.array_sort(F.collect_list(F.struct(*proteins.columns))).alias("_proteins"))
    seen = F.lit(None) if known is None else F.try_element_at(F.col(known), F.col("_run"))
    kept = [c for c in rows.columns if c != known]
    out = None
    for number in range(blocks):
        block = of_runs.filter(F.pmod("_run", F.lit(blocks)) == number) if blocks > 1 else of_runs
        each = rows.crossJoin(F.broadcast(block.select("_run"))).select(*kept, "_run", seen.alias("_seen"))
        # Spark leaves out a sort below a join, unless a filter is between them that it can't move.
        each = each.sortWithinPartitions("_run").filter(F.monotonically_increasing_id() >= 0)
        made = each.join(F.broadcast(block), "_run").select(*kept, "_seen", F.explode("_proteins").alias("_protein")).withColumn("protein_id", F.col("_protein.protein_id"))
        if known is not None:
            made = made.filter(~F.coalesce(F.array_contains("_seen", F.col("protein_id")), F.lit(False)))
        made = made.drop("_seen")
        out = made if out is None else out.unionByName(made)
    return out


def _compounds(compounds: DataFrame) -> DataFrame:
    """Distinct compounds in a number of tasks that grows with them and that Spark doesn't lower: they are few, what is made of them is not."""
    tasks = max(int(compounds.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-compounds.count() // COMPOUNDS_OF_TASK))
    return compounds.select("cid").repartition(tasks, "cid").distinct()


def hashed_pairs(compounds: DataFrame, proteins: DataFrame, seed: int = 13, broadcast_rows: int = 100_000) -> tuple[DataFrame, Column]:
    """All compound-protein pairs with the texts that ``hash_order`` is made of, each made once for its compound or protein, and that hash."""
    text = lambda c: F.col(c).cast("string").alias("_text")
    pairs = _product(_compounds(compounds).withColumn("_first", F.concat_ws("|", F.lit(str(seed)), F.col("cid").cast("string"))), proteins.select("protein_id").distinct().select("protein_id", text("protein_id")), broadcast_rows)
    return pairs, F.sha1(F.concat_ws("|", "_first", "_protein._text").cast("binary"))


def candidate_pairs(compounds: DataFrame, proteins: DataFrame, observed: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """All compound-protein pairs that were not observed. The product is the result; proteins are broadcast after a
    count, and beyond ``broadcast_rows`` in blocks of that size.

    Each compound carries the proteins that it was observed with, by run of proteins, so that the product itself is neither
    shuffled nor written: what is on disk grows with the observed pairs."""
    ids = proteins.select("protein_id").distinct()
    _, run = _runs(ids, broadcast_rows)
    of_run = observed.select(*PAIR).filter("cid is not null and protein_id is not null").groupBy("cid", run.alias("_run")).agg(F.collect_set("protein_id").alias("_seen"))
    known = of_run.groupBy("cid").agg(F.map_from_entries(F.collect_list(F.struct("_run", "_seen"))).alias("_known"))
    return _product(_compounds(compounds).join(known.hint("merge"), "cid", "left"), ids, broadcast_rows, "_known").select(*PAIR)


def candidate_counts(compounds: DataFrame, proteins: DataFrame, observed: DataFrame) -> DataFrame:
    """How many pairs of ``candidate_pairs`` each protein has, without the product: all compounds less its observed ones."""
    ids = compounds.filter("cid is not null").select("cid").distinct()
    seen = observed.select(*PAIR).distinct().join(ids, "cid", "left_semi").groupBy("protein_id").agg(F.count("*").alias("n_seen"))
    left = F.col("n_compounds") - F.coalesce("n_seen", F.lit(0))
    counts = proteins.filter("protein_id is not null").select("protein_id").distinct().join(seen, "protein_id", "left").crossJoin(F.broadcast(ids.agg(F.count("*").alias("n_compounds"))))
    return counts.select("protein_id", left.alias("n_candidates")).filter("n_candidates > 0")


def space_counts(pairs: DataFrame, compounds: DataFrame, proteins: DataFrame) -> DataFrame:
    """n_positive and n_candidates of each protein: its positive ``pairs(cid, protein_id, label)``, each there once, and the pairs of
    ``candidate_pairs`` that are not among them. Made of one pass over the pairs, without the product."""
    ids = compounds.filter("cid is not null").select("cid").distinct()
    marked = pairs.join(ids.withColumn("_known", F.lit(1)).hint("merge"), "cid", "left")
    of_pairs = marked.groupBy("protein_id").agg(F.count_if(F.col("label") == 1).alias("n_positive"), F.count("_known").alias("_seen"), F.lit(True).alias("_measured"))
    every = proteins.filter("protein_id is not null").select("protein_id", F.lit(True).alias("_listed")).distinct()
    both = of_pairs.join(every, "protein_id", "full").crossJoin(F.broadcast(ids.agg(F.count("*").alias("_compounds"))))
    n = F.when(F.col("_listed"), F.col("_compounds") - F.coalesce("_seen", F.lit(0))).otherwise(0)
    return both.filter(F.coalesce("_measured", F.lit(False)) | (n > 0)).select("protein_id", F.coalesce("n_positive", F.lit(0)).alias("n_positive"), n.alias("n_candidates"))


def hash_order(keys: list[str], seed: int) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), *keys).cast("binary"))


def sampled(df: DataFrame, keys: list[str], n: int, seed: int = 13) -> DataFrame:
    """The first ``n`` rows in the order of a seeded hash of the keys."""
    return df.orderBy(hash_order(keys, seed), *keys).limit(n)


def sampled_of_many(df: DataFrame, keys: list[str], n: int, total: int, seed: int = 13, per_block: int = 1 << 16, hashed: Column | None = None, left_out: DataFrame | None = None) -> DataFrame:
    """``sampled`` of about ``total`` rows whose keys are distinct, for large ``n``: hashes are spread evenly, so rows above the place
    where ``n`` are expected, and some, go at once; if too few are left, twice as many are kept. Of the kept rows whole blocks
    of hashes are taken, and only the last one, of about ``per_block`` rows, is sorted. ``hashed`` is ``hash_order``, where there is a
    shorter way to it. Rows of ``left_out`` don't count: they go from those that are kept, which are few, not from all."""
    whole = 1 << 52
    row = df.withColumn("_hash", hash_order(keys, seed) if hashed is None else hashed)
    kept = min(1.0, (1.02 * n + 1000) / max(total, 1))
    while True:
        width = max(1, int(whole * kept) // max(1, n // per_block))
        # Texts of as many digits compare as their numbers do, so only kept rows get a number.
        near = row.filter(F.col("_hash") < f"{int(whole * kept) + 1:013x}") if kept < 1.0 else row
        near = near.select(*keys, "_hash") if left_out is not None else near
        if left_out is not None:
            near = near.join(left_out.select(*keys).distinct(), keys, "left_anti")
        place = F.conv(F.substring("_hash", 1, 13), 16, 10).cast("long")
        found = written(near.withColumn("_block", F.floor(place / width)), "sampled")
        counts = sorted(found.groupBy("_block").agg(F.count("*").alias("n")).collect())
        if kept >= 1.0 or sum(r.n for r in counts) >= n:
            break
        kept = min(1.0, 2 * kept)
    last, before = None, 0
    for r in counts:
        if before + r.n > n:
            last = r["_block"]
            break
        before += r.n
    columns = df.columns if left_out is None else keys
    if last is None:
        return found.select(*columns)
    rest = found.filter(F.col("_block") == last).orderBy("_hash", *keys).limit(n - before)  # about a block
    return found.filter(F.col("_block") < last).unionByName(rest).select(*columns)


def path_edges(*hops: tuple[DataFrame, str, str]) -> DataFrame:
    """Distinct (start, end) pairs over a chain of edge tables; each hop names its start and end columns."""
    first, start, end = hops[0]
    out = first.select(F.col(start).alias("start"), F.col(end).alias("end"))
    for edges, a, b in hops[1:]:
        out = out.join(edges.select(F.col(a).alias("end"), F.col(b).alias("_next")), "end").select("start", F.col("_next").alias("end")).distinct()
    return out.distinct()


def held_out(pairs: DataFrame, split: str = "split") -> dict[str, DataFrame]:
    """Measurements and groups behind the pairs that are not in train."""
    tests = pairs.filter(F.col(split) != "train")
    return {"endpoint_id": tests.select(F.explode("endpoint_ids").alias("endpoint_id")).distinct(), "cid": tests.select("cid").distinct()}


def edge_partition(edges: DataFrame, held_refs: DataFrame, cold_refs: DataFrame) -> DataFrame:
    """Edges (start, end) as train_only, transductive_safe (touch a held-out compound only) or removed (touch
    held-out evidence)."""

    def marked(df, refs, name):
        for side in ("start", "end"):
            df = df.join(refs.select(F.col("ref").alias(side), F.lit(True).alias(f"_{name}_{side}")).distinct(), side, "left")
        return df.withColumn(name, F.coalesce(f"_{name}_start", f"_{name}_end", F.lit(False))).drop(f"_{name}_start", f"_{name}_end")

    both = marked(marked(edges, held_refs, "held"), cold_refs, "cold")
    return both.withColumn("part", F.when(F.col("held"), "removed").when(F.col("cold"), "transductive_safe").otherwise("train_only")).drop("held", "cold")

"""Tables for models: pair features from text and binding records, candidate sets, node features, tensors, and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .evidence import PAIR, candidate_pairs, hashed_pairs, sampled_of_many
from .features import model_matrix
from .graph import dense_ids, fanned_out, links_by_members, reversed_edges

#: Score of a co-mention without one: found in text, or of unknown origin.
TEXT_SCORE, OTHER_SCORE = 0.25, 0.1


def comention_pairs(compounds: DataFrame, proteins: DataFrame, genes: DataFrame, gene_proteins: DataFrame, mentions: DataFrame) -> DataFrame:
    """Distinct (cid, protein_id, mention_id) with score: the compounds of a co-mention with its proteins and those of its
    genes. ``mentions(mention_id, score, level)`` gives the score, or by its level one in its place."""
    through = genes.join(gene_proteins, "gene_id").select("mention_id", "protein_id")
    targets = proteins.select("mention_id", "protein_id").unionByName(through).distinct()
    weak = F.when(F.coalesce(F.col("level").startswith("text_mined"), F.lit(False)), TEXT_SCORE).otherwise(OTHER_SCORE)
    scored = mentions.select("mention_id", F.coalesce(F.col("score").cast("double"), weak).alias("score"))
    return compounds.select("mention_id", "cid").distinct().join(targets, "mention_id").join(scored, "mention_id", "left").select(*PAIR, "mention_id", "score")


def comention_pair_features(pairs: DataFrame, references: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """Counts of co-mentions and of their references, and the highest and mean score of each pair. References are counted
    apart, so that a co-mention with several weighs once in the mean."""
    scores = pairs.groupBy(*keys).agg(F.count_distinct("mention_id").alias("textmine_cooc_count"), F.max("score").alias("textmine_score_max"), F.avg("score").alias("textmine_score_mean"))
    cited = pairs.select(*keys, "mention_id").join(references.select("mention_id", "reference_id").distinct(), "mention_id").groupBy(*keys).agg(F.count_distinct("reference_id").alias("textmine_reference_count"))
    return scores.join(cited, keys, "left").withColumn("textmine_reference_count", F.coalesce("textmine_reference_count", F.lit(0)))


def comention_features_through_genes(compounds: DataFrame, proteins: DataFrame, genes: DataFrame, gene_proteins: DataFrame, mentions: DataFrame, references: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """``comention_pair_features`` of ``comention_pairs``, without shuffling the pairs that come through genes, whose number grows with
    the square of the tables. A protein of one gene that is not mentioned itself with a compound has the features of compound
    and gene, which are made once and fan out last; only the other pairs are looked at one by one."""
    links = lambda df, c: df.select("mention_id", c).distinct()
    single, several = links_by_members(gene_proteins.select("gene_id", "protein_id"), "gene_id", "protein_id")
    with_genes = written(links(compounds, "cid").join(links(genes, "gene_id").filter("gene_id is not null"), "mention_id"), "comentions-of-genes")
    direct = written(links(compounds, "cid").join(links(proteins, "protein_id"), "mention_id"), "comentions-of-proteins")
    named = direct.select(*PAIR).distinct().join(single, "protein_id").select(F.col("cid").alias("_cid"), F.col("gene_id").alias("_gene"), "protein_id")
    same = F.col("cid").eqNullSafe(F.col("_cid")) & (F.col("gene_id") == F.col("_gene"))
    rows = direct.select(*PAIR, "mention_id").unionByName(with_genes.join(several, "gene_id").select(*PAIR, "mention_id")).unionByName(with_genes.join(named, same).select(*PAIR, "mention_id")).distinct()
    weak = F.when(F.coalesce(F.col("level").startswith("text_mined"), F.lit(False)), TEXT_SCORE).otherwise(OTHER_SCORE)
    scored = mentions.select("mention_id", F.coalesce(F.col("score").cast("double"), weak).alias("score"))
    one_by_one = comention_pair_features(rows.join(scored, "mention_id", "left"), references)
    of_genes = comention_pair_features(with_genes.join(scored, "mention_id", "left"), references, ["cid", "gene_id"])
    left_out = named.groupBy("_cid", "_gene").agg(F.collect_set("protein_id").alias("_named"))
    wide = of_genes.join(left_out, same, "left").drop("_cid", "_gene")
    return one_by_one.unionByName(fanned_out(wide, single, "gene_id", "protein_id", "_named", broadcast_rows).select(*one_by_one.columns))


def binding_pairs(compounds: DataFrame, proteins: DataFrame, endpoints: DataFrame, endpoint_substance: DataFrame, substance_compound: DataFrame, groups: DataFrame, tested_on: DataFrame) -> DataFrame:
    """Distinct (cid, protein_id, record_id) of binding records: directly linked to both, or through a measurement's
    substance and group. ``endpoint_substance`` and ``substance_compound`` have one row a key."""
    direct = compounds.select("record_id", "cid").join(proteins.select("record_id", "protein_id"), "record_id")
    # All of these grow with the measurements: a broadcast would be held whole by every task.
    of = lambda df: df.hint("merge")
    measured = endpoints.select("record_id", "endpoint_id").join(of(endpoint_substance), "endpoint_id").join(of(groups.select("endpoint_id", "mg_id")), "endpoint_id")
    through = measured.join(of(substance_compound), "sid").join(of(tested_on), "mg_id")
    return direct.select(*PAIR, "record_id").unionByName(through.select(*PAIR, "record_id")).distinct()


def candidate_limit(total: int, positives: int, mode: str = "sampled", most: int | None = None) -> int:
    """How many unobserved pairs become candidates: all, at most ``most``, or ten times the positives and 1000 at least."""
    if mode == "all":
        return total
    return max(0, min(total, most if most is not None else max(1000, 10 * positives)))


#: Keys of the rounds of ``drawn_index``, before the seed; a prime that fits products into a long.
ROUND_KEYS, PRIME = (1_093_511, 7_368_787, 15_485_863, 32_452_843), (1 << 31) - 1


def round_keys(seed: int) -> list[int]:
    return [(k + 1_000_003 * seed * (i + 1)) % PRIME for i, k in enumerate(ROUND_KEYS)]


def drawn_index(draw: Column, half: int, seed: int) -> Column:
    """A permutation of 0 to 4**half - 1 chosen by the seed: four Feistel rounds over two halves of ``half`` bits (31 at most)."""
    low = (1 << half) - 1
    left, right = F.shiftright(draw, half), draw.bitwiseAND(low)
    for key in round_keys(seed):
        x = (right + key) % PRIME
        mixed = (x * x + 48271 * x) % PRIME
        left, right = right, left.bitwiseXOR(mixed.bitwiseXOR(F.shiftright(mixed, 15)).bitwiseAND(low))
    return F.shiftleft(left, half).bitwiseOR(right)


def drawn_pairs(compounds: DataFrame, proteins: DataFrame, observed: DataFrame, n: int, seed: int = 13, block: int = 1 << 16) -> DataFrame:
    """``n`` unobserved pairs (all, if there are fewer), drawn without replacement and without the product.

    Compounds and proteins are numbered, so that a pair has an index; draws 0, 1, 2 ... go through a permutation of the
    indexes that the seed chooses, and the first ``n`` whose image is an unobserved pair are taken. About as many draws are
    made as are needed (twice as many again if too few were taken); the last one comes from counts of ``block`` draws each.
    """
    a = dense_ids(compounds.filter("cid is not null").select("cid").distinct(), ["cid"], "_a")
    b = dense_ids(proteins.filter("protein_id is not null").select("protein_id").distinct(), ["protein_id"], "_b")
    n_a, n_b = a.count(), b.count()
    index = (F.col("_a") * n_b + F.col("_b")).alias("_pair")
    taken = written(observed.select(*PAIR).distinct().join(a, "cid").join(b, "protein_id").select(index), "observed-indexes")
    free = n_a * n_b - taken.count()
    n = max(0, min(n, free))
    half = max(1, -(-(n_a * n_b - 1).bit_length() // 2)) if n_a * n_b else 1
    if half > 31:
        raise ValueError("more than 2**62 pairs")
    domain = 1 << 2 * half
    draws = min(domain, 1000 + n * domain // max(free, 1) * 11 // 10)
    while True:
        made = a.sparkSession.range(draws).select(F.col("id").alias("_draw"), drawn_index(F.col("id"), half, seed).alias("_pair")).filter(F.col("_pair") < n_a * n_b)
        # Few rows: what was drawn.
        found = written(made.join(taken, "_pair", "left_anti").withColumn("_block", F.floor(F.col("_draw") / block)), "drawn")
        counts = sorted(found.groupBy("_block").agg(F.count("*").alias("n")).collect())
        if draws == domain or sum(r.n for r in counts) >= n:
            break
        draws = min(domain, 2 * draws)
    last, before = -1, 0
    for r in counts:
        if before + r.n > n:
            last = r["_block"]
            break
        before += r.n
    whole = found if last < 0 else found.filter(F.col("_block") < last)
    rest = found.filter(F.col("_block") == last).orderBy("_draw").limit(n - before)  # at most a block
    indexed = whole.unionByName(rest).select(F.floor(F.col("_pair") / F.lit(max(n_b, 1))).alias("_a"), F.pmod("_pair", F.lit(max(n_b, 1))).alias("_b"))
    return indexed.join(a, "_a").join(b, "_b").select(*PAIR)


def candidates(compounds: DataFrame, proteins: DataFrame, observed: DataFrame, positives: int, mode: str = "sampled", most: int | None = None, seed: int = 13) -> DataFrame:
    """Unobserved pairs by ``candidate_limit``, with how they were chosen: "sampled" draws them, "hash_order" takes the first in the order
    of a seeded hash of all pairs (whose product it makes), "all" takes all."""
    if mode == "all":
        return candidate_pairs(compounds, proteins, observed).withColumn("candidate_sampling_method", F.lit("all_materialized_unobserved_within_extracted_scope"))
    limit = candidate_limit(1 << 62, positives, mode, most)
    if mode == "hash_order":
        total = compounds.select("cid").distinct().count() * proteins.select("protein_id").distinct().count()
        every, hashed = hashed_pairs(compounds, proteins, seed)
        chosen = sampled_of_many(every, PAIR, limit, total, seed, hashed=hashed, left_out=observed)
    else:
        chosen = drawn_pairs(compounds, proteins, observed, limit, seed)
    return chosen.withColumn("candidate_sampling_method", F.lit("unobserved_within_extracted_scope"))


def candidates_of_observed(every: DataFrame, observed: DataFrame) -> DataFrame:
    """The candidates whose compound is observed with another protein."""
    return every.join(observed.select("cid").distinct(), "cid", "left_semi").withColumn("candidate_sampling_method", F.lit("observed_compounds_only_unobserved_targets"))


def candidate_counts_of_observed(compounds: DataFrame, proteins: DataFrame, observed: DataFrame) -> DataFrame:
    """How many pairs of ``candidates_of_observed`` each compound has, without the product: all proteins less its observed ones."""
    ids, known = proteins.select("protein_id").distinct(), compounds.select("cid").distinct()
    pairs = observed.select(*PAIR).distinct()
    seen = pairs.join(ids.withColumn("_known", F.lit(1)), "protein_id", "left").groupBy("cid").agg(F.count("_known").alias("_seen")).join(known, "cid", "left_semi")
    counts = seen.crossJoin(F.broadcast(ids.agg(F.count("*").alias("_all"))))
    return counts.select("cid", (F.col("_all") - F.col("_seen")).alias("n")).filter("n > 0")


def link_pairs(training: DataFrame, unknown: DataFrame) -> DataFrame:
    """Labelled pairs and candidates in one table; candidates have the label ``unknown``."""
    labelled = training.select(*PAIR, F.col("label").cast("string").alias("label"))
    return labelled.unionByName(unknown.select(*PAIR, F.lit("unknown").alias("label")))


def with_side_tables(rows: DataFrame, key: str, sides: dict[str, DataFrame], left_out: tuple[str, ...] = ("synonyms", "raw_neighbors")) -> DataFrame:
    """``rows`` with the columns of side tables (one row a key) behind their names; ``left_out`` columns aren't taken."""
    for name, side in sides.items():
        wanted = [c for c in side.columns if c != key and c not in left_out]
        rows = rows.join(side.select(key, *(F.col(c).alias(f"{name}_{c}") for c in wanted)), key, "left")
    return rows


def first_version(representations: DataFrame, key: str, version: str, versions: list[str]) -> DataFrame:
    """Of each key the representation of the first of ``versions`` that it has; other versions aren't taken."""
    rank = F.array_position(F.array(*map(F.lit, versions)), F.col(version))
    rest = [c for c in representations.columns if c != key]
    best = representations.filter(rank > 0).groupBy(key).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return best.select(key, *(F.col(f"_row.{c}").alias(c) for c in rest))


def compound_features(compounds: DataFrame, similarity_degree: DataFrame, sides: dict[str, DataFrame]) -> DataFrame:
    """``compounds(cid, ...)`` with their similarity degree (0 without neighbours) and side tables."""
    degree = F.coalesce("similarity_degree", F.lit(0))
    rows = compounds.join(similarity_degree.select("cid", F.col("degree").alias("similarity_degree")), "cid", "left")
    return with_side_tables(rows.withColumns({"similarity_degree": degree, "has_similarity_neighbors": degree > 0}), "cid", sides)


def protein_features(proteins: DataFrame, records: DataFrame, embeddings: DataFrame, annotations: DataFrame) -> DataFrame:
    """``proteins(protein_id, name, taxid, sequence)`` with the record of their accession, the number and methods of its
    embeddings, and how many annotations they have by type.

    The accession comes from the id, and that of an embedding from its own column or its id (``protembed:<accession>:...``),
    so both are equal keys. ``records(accession, protein_name, taxid, reviewed, sequence_length)`` and
    ``annotations(protein_id, type, ref)``.
    """
    text = F.upper(F.trim(F.col("protein_id").cast("string")))
    rows = proteins.withColumn("uniprot_acc", F.when(text.startswith("ACC"), F.substr(text, F.lit(4))).otherwise(text))
    record = records.select(F.col("accession").alias("uniprot_acc"), F.col("protein_name").alias("_name"), F.col("taxid").alias("_taxid"), F.col("reviewed").alias("uniprot_reviewed"), F.col("sequence_length").alias("uniprot_sequence_length"))
    own = F.coalesce(F.nullif(F.trim("uniprot_acc"), F.lit("")), F.regexp_extract("embedding_id", r"^protembed:([^:]+):", 1))
    found = embeddings.select("embedding_id", own.alias("uniprot_acc"), "method").groupBy("uniprot_acc").agg(F.count_distinct("embedding_id").alias("n_embeddings"), F.array_join(F.array_sort(F.collect_set("method")), " | ").alias("embedding_methods"))
    counts = annotations.groupBy("protein_id", "type").agg(F.count_distinct("ref").alias("n"))
    wide = counts.groupBy("protein_id").agg(F.map_from_entries(F.collect_list(F.struct("type", "n"))).alias("annotation_counts"))
    joined = rows.join(record, "uniprot_acc", "left").join(found, "uniprot_acc", "left").join(wide, "protein_id", "left")
    size = F.length(F.nullif(F.col("sequence"), F.lit("")))
    return joined.withColumns(
        {
            "name": F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.col("_name")),
            "taxid": F.coalesce(F.col("taxid"), F.col("_taxid")),
            "sequence_length": F.coalesce(size, F.col("uniprot_sequence_length")),
            "has_sequence": size.isNotNull(),
            "n_embeddings": F.coalesce("n_embeddings", F.lit(0)),
        }
    ).drop("_name", "_taxid")


def embedding_features(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row for each embedding, its dimensions as columns ``emb_0000`` on; the width is that of the first one by id."""
    first = embeddings.filter(F.col(vector).isNotNull()).orderBy("embedding_id").select(F.size(vector)).first()
    width = first[0] if first else 0
    rest = [c for c in embeddings.columns if c != vector]
    return embeddings.select(*rest, F.size(vector).alias("dim"), *(F.get(vector, F.lit(k)).alias(f"emb_{k:04d}") for k in range(width)))


def tensor(rows: DataFrame, ids: list[str], order: list[str], fit_rows: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The numeric matrix of ``rows`` and the table that says which row is which: both have ``row_idx`` from 0 in the given
    order; the matrix has no identifiers, and no value in it is null or not finite."""
    placed = dense_ids(rows, order, "row_idx")
    fit = None if fit_rows is None else placed.join(fit_rows.select(*ids).distinct(), ids, "left_semi")
    matrix = model_matrix(placed, [*ids, "row_idx"], fit)
    values = [c for c in matrix.columns if c.startswith(("x_", "missing_"))]
    return matrix.select("row_idx", *values), placed.select("row_idx", *ids)


def graph_triples(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct (head, relation, tail) of ``edges(source_node_id, target_node_id, schema_label, type)`` by the names in
    ``entities(node_id, entity)``; edges without a name at either end or a relation go."""
    name = lambda side: entities.select(F.col("node_id").alias(f"{side}_node_id"), F.col("entity").alias(side))
    relation = F.coalesce(F.nullif(F.trim("schema_label"), F.lit("")), F.nullif(F.trim("type"), F.lit("")))
    joined = edges.join(name("source"), "source_node_id").join(name("target"), "target_node_id")
    return joined.select(F.col("source").alias("head"), relation.alias("relation"), F.col("target").alias("tail")).filter("relation is not null").distinct()


def split_name(c):
    """``val`` for any word for it, ``train`` where none is given."""
    text = F.lower(F.trim(F.coalesce(c, F.lit("train"))))
    return F.when(text.isin("validation", "valid"), "val").otherwise(text)


def pair_triples(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(head, INTERACTS_WITH, tail) and ``part`` of pairs: train, valid and test of the positive ones, candidate of the
    unlabelled ones. ``pairs(compound_node_id, protein_node_id, label, split)``."""
    name = lambda side: entities.select(F.col("node_id").alias(f"{side}_node_id"), F.col("entity").alias(side))
    label, split = F.lower(F.trim("label")), split_name(F.col("split"))
    part = F.when(label == "unknown", "candidate").when(label.isin("1", "1.0", "positive", "true"), F.when(split == "val", "valid").when(split == "test", "test").otherwise("train"))
    joined = pairs.join(name("compound"), "compound_node_id").join(name("protein"), "protein_node_id")
    return joined.select(F.col("compound").alias("head"), F.lit("INTERACTS_WITH").alias("relation"), F.col("protein").alias("tail"), part.alias("part")).filter("part is not null")


def local_edge_lists(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges by (start_label, type, end_label) with the local indices of ``nodes(node_ref, label, local_id)``, and their
    reverses, each in a list of its own; edges with an unknown end go."""
    both = reversed_edges(edges)
    end = lambda side: nodes.select(F.col("node_ref").alias(f"{side}_ref"), F.col("label").alias(f"{side}_label"), F.col("local_id").alias(f"{side}_local"))
    return both.join(end("start"), "start_ref").join(end("end"), "end_ref").select("start_label", "type", "end_label", "start_local", "end_local")


def link_labels(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Local indices, label (-1 for unknown) and one mask a split for pairs of ``cid`` and ``protein_id`` references; pairs
    whose label is no number go, and so do those with an unknown end."""
    end = lambda side: nodes.select(F.col("node_ref").alias(f"{side}_ref"), F.col("local_id").alias(f"{side}_local"))
    text = F.lower(F.trim(F.coalesce("label", F.lit("unknown"))))
    unknown = text == "unknown"
    named = split_name(F.col("split"))
    split = F.when(unknown, "unknown").when(named.isin("train", "val", "test"), named).otherwise("train")
    label = F.when(unknown, -1).otherwise(text.try_cast("double").cast("int"))
    rows = pairs.join(end("compound"), "compound_ref").join(end("protein"), "protein_ref").withColumns({"label": label, "split": split})
    return rows.filter("label is not null").select("compound_local", "protein_local", "label", *((F.col("split") == s).alias(f"{s}_mask") for s in ("train", "val", "test", "unknown")))


def held_out_evidence(pairs: DataFrame, interactions: DataFrame) -> DataFrame:
    """kind and ref of all evidence behind pairs that are not in train: measurements and groups listed by the pairs, and
    interactions between them. ``pairs(cid, protein_id, split, endpoint_ids, group_ids)``, ``interactions(interaction_id,
    cid, protein_id)``."""
    held = pairs.filter(split_name(F.col("split")).isin("val", "test"))
    listed = lambda kind, c: held.select(F.lit(kind).alias("kind"), F.explode(c).alias("ref")).withColumn("ref", F.col("ref").cast("string"))
    found = interactions.join(held.select(*PAIR).distinct(), PAIR, "left_semi").select(F.lit("interaction").alias("kind"), F.col("interaction_id").cast("string").alias("ref"))
    return listed("endpoint", "endpoint_ids").unionByName(listed("measuregroup", "group_ids")).unionByName(found).distinct()


def upserted_edges(old: DataFrame, new: DataFrame, schema: DataFrame) -> DataFrame:
    """Edges by (start_ref, end_ref, type, rel_id): of each the last version, new over old. Parallel edges with ids of their
    own stay apart. An edge outside ``schema(start_label, type, end_label)`` is an error."""
    label = lambda side: F.substring_index(f"{side}_ref", "|", 1).alias(f"{side}_label")
    known = schema.select("start_label", "type", "end_label", F.lit(True).alias("_known")).distinct()
    checked = new.select("*", label("start"), label("end")).join(known, ["start_label", "type", "end_label"], "left")
    wrong = F.raise_error(F.concat_ws(" ", F.lit("edge outside the schema:"), "start_label", "type", "end_label"))
    # The check is part of a column that is kept, so that it can't be left out.
    checked = checked.withColumn("rel_id", F.when(F.col("_known"), F.col("rel_id")).otherwise(wrong.cast("string"))).select(*new.columns)
    keys = ["start_ref", "end_ref", "type", "rel_id"]
    rest = [c for c in new.columns if c not in keys]
    both = old.select(*new.columns, F.lit(0).alias("_turn")).unionByName(checked.withColumn("_turn", F.lit(1)))
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_turn").alias("_row"))
    return last.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))

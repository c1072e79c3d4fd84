"""Similar compounds by fingerprint bits, and terms mentioned together in texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.descriptors import BITS, fingerprint, tanimoto
from ..functions.text import searchable, stable_id
from ..sources.shared import written
from .graph import capped, dense_ids


def with_bits(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), fingerprint(text).alias("bits"))


def edge_scores(edges: DataFrame, prints: DataFrame) -> DataFrame:
    """Tanimoto score of the ends of each edge (a, b)."""
    a, b = (prints.select(F.col("id").alias(x), F.col("bits").alias(f"bits_{x}")) for x in ("a", "b"))
    return edges.join(a, "a").join(b, "b").select("a", "b", tanimoto(F.col("bits_a"), F.col("bits_b")).alias("score"))


#: Distinct prints in a block; a task compares two blocks.
BLOCK = 2048


def _blocks(classes: DataFrame, size: int) -> DataFrame:
    """Distinct prints (rep, bits) by rising number of bits, ``size`` of them a row: block, reps, sizes and packed bits."""

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                members = row["members"]
                bits = np.zeros((len(members), BITS), np.uint8)
                for k, m in enumerate(members):
                    bits[k, m["bits"]] = 1
                out.append({"block": row["block"], "reps": [m["rep"] for m in members], "bits": np.packbits(bits).tobytes(), "low": len(members[0]["bits"]), "high": len(members[-1]["bits"])})
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField("block", LongType()), StructField("reps", ArrayType(classes.schema["rep"].dataType)), StructField("bits", BinaryType()), StructField("low", IntegerType()), StructField("high", IntegerType())])
    kinds = to_arrow_schema(schema)
    placed = dense_ids(classes.select("rep", "bits", F.size("bits").alias("n")), ["n", "bits"], "place")
    members = F.array_sort(F.collect_list(F.struct("place", "rep", "bits"))).alias("members")
    return placed.groupBy(F.floor(F.col("place") / size).alias("block")).agg(members).mapInArrow(pack, schema)


def neighbours(prints: DataFrame, threshold: float, top: int, block: int = BLOCK) -> DataFrame:
    """At most ``top`` other items of each item with a Tanimoto score of ``threshold`` or more (over 0), by score, then id.

    Equal prints are one class, which is known by its first ``top + 1`` items: more can't be among anybody's ``top``. Classes are put
    in blocks by their number of bits; a pair of blocks is compared where some sizes allow the score, as a product of 0/1 matrices in one
    task, which keeps of each row the first ``top + 1`` classes. So what is shuffled are blocks (32 bytes a class and pair of blocks)
    and results. Exact; the work within tasks grows with the pairs of classes whose sizes allow the score.
    """
    known = prints.filter(F.size("bits") > 0)
    # Spark keeps no more than top + 1 rows of a class in a task before the exchange.
    ordered = known.select("bits", "id").withColumn("_k", F.row_number().over(Window.partitionBy("bits").orderBy("id"))).filter(F.col("_k") <= top + 1)
    classes = written(ordered.groupBy("bits").agg(F.array_sort(F.collect_list("id")).alias("first")).withColumn("rep", F.col("first")[0]), "print-classes")
    blocks = written(_blocks(classes.select("rep", "bits"), block), "print-blocks")
    a, b = (blocks.select(*(F.col(c).alias(f"{c}_{x}") for c in blocks.columns)) for x in ("a", "b"))
    bounds = blocks.select("block", "low", "high")
    # Numbers of blocks, not prints.
    pairs = bounds.alias("x").join(bounds.alias("y"), (F.col("x.block") <= F.col("y.block")) & (F.col("x.high") >= F.lit(threshold) * F.col("y.low"))).select(F.col("x.block").alias("block_a"), F.col("y.block").alias("block_b"))
    both = pairs.repartition("block_a", "block_b").join(a, "block_a").join(b, "block_b").select("block_a", "block_b", "reps_a", "bits_a", "reps_b", "bits_b")
    kind = dict(classes.dtypes)["rep"]

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        unpacked = lambda data, n: np.unpackbits(np.frombuffer(data, np.uint8)).reshape(n, BITS).astype(np.float32)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                ids = [np.array(row[f"reps_{x}"]) for x in "ab"]
                bits = [unpacked(row[f"bits_{x}"], len(r)) for x, r in zip("ab", ids)]
                shared = (bits[0] @ bits[1].T).astype(np.float64)
                scores = shared / (bits[0].sum(1)[:, None].astype(np.float64) + bits[1].sum(1)[None, :] - shared)
                same = row["block_a"] == row["block_b"]
                if same:
                    np.fill_diagonal(scores, 0)
                for left, right, found in [(0, 1, scores)] + ([] if same else [(1, 0, scores.T)]):
                    at, of = np.nonzero((found >= threshold) & (found > 0))
                    value = found[at, of]
                    order = np.lexsort((ids[right][of], -value, at))
                    at, of, value = at[order], of[order], value[order]
                    starts = np.flatnonzero(np.diff(at, prepend=-1))
                    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
                    keep = place <= top
                    yield pa.RecordBatch.from_arrays([pa.array(ids[left][at[keep]]), pa.array(ids[right][of[keep]]), pa.array(value[keep])], names=["rep", "near", "score"])

    scored = both.mapInArrow(compare, f"rep {kind}, near {kind}, score double")
    itself = classes.select("rep", F.col("rep").alias("near"), F.lit(1.0).alias("score"))
    best = capped(scored, ["rep"], [F.desc("score"), F.col("near")], top + 1).unionByName(itself)
    items = best.join(classes.select(F.col("rep").alias("near"), F.explode("first").alias("other")), "near")
    listed = capped(items.select("rep", "score", "other"), ["rep"], [F.desc("score"), F.col("other")], top + 1)
    lists = listed.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "other"))).alias("near"))
    each = known.select("id", "bits").distinct().join(classes.select("bits", "rep"), "bits").join(lists, "rep")
    found = F.slice(F.filter("near", lambda x: x["other"] != F.col("id")), 1, top)
    return each.select("id", F.explode(found).alias("_n")).select("id", F.col("_n.other").alias("other"), (-F.col("_n.minus")).alias("score"))


def similarity_score(score, threshold: float):
    """An edge's score between 0 and 1: percent is divided, a missing one is the threshold of its search."""
    return F.when(score.isNull(), F.lit(threshold / 100 if threshold > 1 else threshold)).when(score > 1, score / 100).otherwise(score)


# Fixed words that name no compound.
STOP_TERMS = ("compound", "chemical", "unknown", "untitled")


def _dictionary(rows: DataFrame, key: str, terms: Column, seq: str, most: int) -> DataFrame:
    """term_id and its distinct terms in order (the first ``most``), each with its place and what texts are searched for; of several rows
    of a key the first that has terms counts."""
    listed = rows.select(F.col(key).alias("term_id"), F.col(seq).alias("_seq"), F.slice(F.array_distinct(terms), 1, most).alias("terms")).filter(F.col("term_id").isNotNull() & (F.size("terms") > 0))
    first = listed.groupBy("term_id").agg(F.min_by("terms", "_seq").alias("terms"))
    return first.select("term_id", F.posexplode("terms").alias("place", "term")).withColumn("phrase", searchable("term"))


def compound_dictionary(rows: DataFrame, key: str, seq: str, names: list[str], synonyms: list[str] = (), most: int = 12) -> DataFrame:
    """Terms by which texts name compounds: ``names``, then ``synonyms`` (lists as text, `` | `` between them); of 4 to 80 characters,
    not only an id (``CID ...``) and no stop term."""
    trimmed = lambda c: F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"^\s+|\s+$", ""))
    every = F.concat(F.array(*(F.col(n).cast("string") for n in names)), *(F.coalesce(F.split(F.col(n), r"\s*\|\s*"), F.array().cast("array<string>")) for n in synonyms))
    wanted = lambda x: F.length(x).between(4, 80) & ~F.lower(x).startswith("cid ") & ~F.lower(x).isin(*STOP_TERMS)
    return _dictionary(rows, key, F.filter(F.transform(every, trimmed), wanted), seq, most)


def target_dictionary(rows: DataFrame, key: str, seq: str, symbol: str, others: list[str], most: int = 12) -> DataFrame:
    """Terms by which texts name targets: a CYP symbol and its cytochrome names first, then the symbol and ``others`` of three characters or
    more."""
    trimmed = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    upper = F.upper(trimmed(symbol))
    rest = F.regexp_replace(upper, "CYP", "")
    special = F.when(upper.startswith("CYP") & (rest != ""), F.array(upper, F.concat(F.lit("cytochrome P450 "), rest), F.concat(F.lit("cytochrome P450 "), upper))).when(upper.startswith("CYP"), F.array(upper)).otherwise(F.array().cast("array<string>"))
    return _dictionary(rows, key, F.concat(special, F.filter(F.array(*map(trimmed, [symbol, *others])), lambda x: F.length(x) >= 3)), seq, most)


#: Characters of phrases that one automaton holds; it takes about a hundred bytes for each.
AUTOMATON_CHARS = 2_000_000


#: Characters of snippets of an Arrow batch that goes back to Spark, about.
SNIPPET_CHARS = 4_000_000


def _searched(texts: DataFrame, phrases: DataFrame, text_id: str, width: int = 500, most: int = SNIPPET_CHARS) -> DataFrame:
    """text_id, phrase and snippet of every phrase in every text, in one pass over the texts with an automaton of the phrases. Texts are
    taken out of a batch one by one, and what is found goes back as soon as it has ``most`` characters, however many rows Spark
    puts in a batch."""
    known = texts.sparkSession.sparkContext.broadcast([r.phrase for r in phrases.collect()])
    kept = texts.schema[text_id]
    source = texts.select(text_id, searchable("text").alias("_text"))

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        words = known.value
        if not words:
            return
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, phrase in enumerate(words):
            automaton.add_word(phrase, k)
        automaton.make_automaton()
        as_word = [len(p) <= 5 and p.isascii() and p.isalnum() for p in words]
        sizes = [len(p) for p in words]
        inside = lambda c: c.isalnum() or c == "_"
        def made(batch, rows, found, snippets):
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string()), pa.array(snippets, pa.string())], names=[text_id, "phrase", "snippet"])

        for batch in batches:
            rows, found, snippets, held = [], [], [], 0
            for row, value in enumerate(batch.column(1)):
                text = value.as_py()
                hits = set()
                for last, k in automaton.iter(text):
                    if k not in hits:
                        first = last + 1 - sizes[k]
                        if as_word[k] and (first and inside(text[first - 1]) or last + 1 < len(text) and inside(text[last + 1])):
                            continue
                        hits.add(k)
                for k in sorted(hits):
                    start = max(0, text.find(words[k]) - width // 2)
                    rows.append(row)
                    found.append(words[k])
                    snippets.append(text[start : start + width])
                    held += len(snippets[-1])
                    if held >= most:
                        yield made(batch, rows, found, snippets)
                        rows, found, snippets, held = [], [], [], 0
            if rows:
                yield made(batch, rows, found, snippets)

    return source.mapInArrow(run, StructType([kept, StructField("phrase", StringType()), StructField("snippet", StringType())]))


def mentions(texts: DataFrame, terms: DataFrame, text_id: str, per_text: int = 25, most_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """Terms found in texts: ``terms(term_id, phrase)`` in ``texts(text_id, text)``, the first ``per_text`` terms a text by term_id, each with one
    phrase that is there (the first of its dictionary's ``place``, or by letters) and the text around it.

    A phrase of up to five ASCII letters or digits must stand as a word, others may be parts of words. Texts aren't shuffled: tasks
    search them with an Aho-Corasick automaton of the broadcast dictionary, whose size is counted first; a dictionary of more than
    ``most_chars`` characters takes several passes. Only what is found is joined with term ids.
    """
    keyed = terms.select("term_id", F.col("place") if "place" in terms.columns else F.lit(0).alias("place"), searchable("phrase").alias("phrase")).filter("phrase != ''")
    phrases = written(keyed.select("phrase").distinct(), "phrases")
    total = phrases.agg(F.sum(F.length("phrase") + 1).alias("n")).first().n or 0
    blocks = -(-total // most_chars) or 1
    found = None
    for block in range(blocks):
        part = phrases.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block)
        some = _searched(texts, part, text_id)
        found = some if found is None else found.unionByName(some)
    hits = found.join(keyed, "phrase")
    each = hits.groupBy(text_id, "term_id").agg(F.min(F.struct("place", "phrase", "snippet")).alias("_m")).select(text_id, "term_id", "_m.phrase", "_m.snippet")
    return capped(each, [text_id], [F.col("term_id")], per_text)


def comentions(left: DataFrame, right: DataFrame, text_id: str, per_pair: int = 10, score: float = 0.25) -> DataFrame:
    """Pairs of terms in one text (left_id, right_id), at most ``per_pair`` texts each, with a stable id and a weak score."""
    a = left.select(text_id, F.col("term_id").alias("left_id"))
    b = right.select(text_id, F.col("term_id").alias("right_id"))
    pairs = a.join(b, text_id).withColumn("mention_id", stable_id(F.col("left_id"), F.col("right_id"), F.col(text_id), prefix="comention:", digits=16))
    return capped(pairs, ["left_id", "right_id"], [F.col(text_id)], per_pair).withColumn("score", F.lit(score))

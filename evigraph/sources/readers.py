"""Readers of seed lists, JSON lines, triples, result tables, delimited files, XML, schema documents and manifests.

All go through Spark's readers, so a path may lie in any store that Spark reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import col, first_text

NTRIPLE = r"^\s*(<[^>]*>|_:\S+)\s+(<[^>]*>)\s+(<[^>]*>|_:\S+|\"(?:[^\"\\]|\\.)*\"(?:@[A-Za-z-]+|\^\^<[^>]*>)?)\s*\.\s*$"


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Seeds, one a line; blank lines and comments go."""
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id != '' and not startswith(id, '#')")


def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """JSON lines; malformed ones fail (strict) or are dropped."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def triples_of(line: Column | str) -> Column:
    """Subject, predicate and object of a line; null if it is no triple."""
    text = col(line)
    return F.when(text.rlike(NTRIPLE), F.struct(*(F.regexp_extract(text, NTRIPLE, k).alias(n) for k, n in enumerate("spo", 1))))


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of a plain or gzip file; lines that are none are skipped."""
    return spark.read.text(path).select(triples_of("value").alias("t")).filter("t is not null").select("t.*")


def ntriples_text(df: DataFrame, text: str) -> DataFrame:
    """Triples of texts that hold one a line."""
    return df.select(F.explode(F.split(text, "\n")).alias("line")).select(triples_of("line").alias("t")).filter("t is not null").select("t.*")


def _cell(markup: Column) -> Column:
    link = r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"']"
    text = F.trim(F.regexp_replace(F.regexp_replace(markup, r"(?s)<[^>]*>", " "), r"\s+", " "))
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.when(markup.rlike(link), F.regexp_extract(markup, link, 1)).otherwise(text)


def html_table_rows(df: DataFrame, html: str, keys: list[str]) -> DataFrame:
    """Rows of the tables in markup as maps from the header's names; a cell is its link, else its text."""
    rows = df.select(*keys, F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>")).alias("rows")).filter(F.size("rows") > 1)
    cells = lambda row, tag: F.transform(F.regexp_extract_all(row, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>")), _cell)
    heads = rows.withColumn("names", cells(F.col("rows")[0], "th"))
    each = heads.select(*keys, "names", F.posexplode(F.slice("rows", F.lit(2), F.size("rows"))).alias("row_no", "row")).withColumn("cells", cells(F.col("row"), "td"))
    same = F.least(F.size("names"), F.size("cells"))
    return each.filter(same > 0).select(*keys, "row_no", F.map_from_arrays(F.slice("names", F.lit(1), same), F.slice("cells", F.lit(1), same)).alias("cells"))


def sparql_rows(df: DataFrame, text: str) -> DataFrame:
    """Bindings of SPARQL results in JSON as maps with lower-case names."""
    schema = "results STRUCT<bindings: ARRAY<MAP<STRING, STRUCT<type: STRING, value: STRING>>>>"
    bindings = df.select(F.explode(F.from_json(text, schema)["results"]["bindings"]).alias("b"))
    return bindings.select(F.transform_values(F.transform_keys("b", lambda k, v: F.lower(k)), lambda k, v: v["value"]).alias("row"))


def header_name(name: str) -> str:
    """A column name in lower case with ``_`` for other characters."""
    import re

    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def delimited(spark: SparkSession, path: str, aliases: dict[str, list[str]] | None = None, cap: int | None = None) -> DataFrame:
    """A delimited file with a header: its separator is the one of comma, tab and semicolon that the header has most
    of; names are normalised; ``aliases`` gives, for a wanted column, the columns whose first value is taken."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0].value if head else ""
    separator = max(",\t;", key=line.count)
    rows = spark.read.option("header", True).option("sep", separator).csv(path)
    rows = rows.toDF(*map(header_name, rows.columns))
    if aliases:
        have = set(rows.columns)
        picked = {name: [c for c in names if c in have] for name, names in aliases.items()}
        rows = rows.withColumns({name: first_text(*names) if names else F.lit(None).cast("string") for name, names in picked.items()})
    return rows if cap is None else rows.limit(cap)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of the paths that exists, in any file system that Spark knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(conf).exists(place):
            return path
    return None


def bibliography(spark: SparkSession, path: str) -> DataFrame:
    """pmid, title and abstract (labelled sections joined) of bibliographic XML records."""
    schema = (
        "MedlineCitation STRUCT<PMID: STRUCT<_VALUE: STRING>, Article: STRUCT<ArticleTitle: STRING, "
        "Abstract: STRUCT<AbstractText: ARRAY<STRUCT<_Label: STRING, _VALUE: STRING>>>>>"
    )
    rows = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(schema).load(path)
    section = lambda s: F.concat_ws(": ", s["_Label"], s["_VALUE"])
    article = F.col("MedlineCitation.Article")
    return rows.select(F.col("MedlineCitation.PMID._VALUE").alias("pmid"), article["ArticleTitle"].alias("title"), F.array_join(F.transform(article["Abstract"]["AbstractText"], section), " ").alias("abstract"))


def schema_document(spark: SparkSession, path: str) -> DataFrame:
    """Edges (start_label, type, end_label) of a DOT document; a node's label is its first line, and a side or type with
    alternatives ``A | B`` gives an edge for each."""
    text = spark.read.text(path, wholetext=True)
    node = r'(?m)^\s*"?(\w+)"?\s*\[[^\]]*?label\s*=\s*"([^"\\|]+)'
    edge = r'(?m)^\s*"?(\w+)"?\s*->\s*"?(\w+)"?\s*\[[^\]]*?label\s*=\s*"([^"]+)"'
    part = lambda pattern, k: F.regexp_extract_all("value", F.lit(pattern), k)
    nodes = text.select(F.explode(F.arrays_zip(part(node, 1).alias("n"), part(node, 2).alias("l"))).alias("x")).select("x.n", F.trim("x.l").alias("l"))
    edges = text.select(F.explode(F.arrays_zip(part(edge, 1).alias("a"), part(edge, 2).alias("b"), part(edge, 3).alias("t"))).alias("x")).select("x.*")
    name = lambda side: nodes.select(F.col("n").alias(side), F.col("l").alias(f"{side}_l"))
    joined = edges.join(name("a"), "a", "left").join(name("b"), "b", "left")
    kinds = F.explode(F.split("t", r"\s*\|\s*"))
    return joined.select(F.coalesce("a_l", "a").alias("start_label"), kinds.alias("type"), F.coalesce("b_l", "b").alias("end_label"))


def manifest(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """A run's one-row manifest; fields it lacks come from the manifest of its source run."""
    own = spark.read.option("multiLine", True).json(path)
    if source is None:
        return own
    other = spark.read.option("multiLine", True).json(source)
    names = [*own.columns, *(c for c in other.columns if c not in own.columns)]
    joined = own.select(*(F.col(c).alias(f"a_{c}") for c in own.columns)).join(F.broadcast(other.select(*(F.col(c).alias(f"b_{c}") for c in other.columns)).limit(1)))
    pick = lambda c: F.coalesce(*(F.col(f"{x}_{c}") for x, cols in (("a", own.columns), ("b", other.columns)) if c in cols))
    return joined.select(*(pick(c).alias(c) for c in names))


def cross_references(records: DataFrame, key: str, xrefs: str, database: str, cap: int = 100) -> DataFrame:
    """Entries of one database in a record's ``ARRAY<STRUCT<database, id, properties: MAP>>``, at most ``cap`` each, with
    the term's aspect and name split at its first colon."""
    each = records.select(key, F.posexplode(F.slice(F.filter(xrefs, lambda x: x["database"] == database), 1, cap)).alias("place", "x"))
    term = F.coalesce(F.col("x.properties")["GoTerm"], F.col("x.properties")["EntryName"], F.col("x.properties")["PathwayName"])
    parts = F.split(term, ":", 2)
    return each.select(key, "place", F.col("x.id").alias("ref_id"), F.when(F.size(parts) > 1, parts[0]).alias("aspect"), F.coalesce(F.get(parts, F.lit(1)), parts[0]).alias("name"), F.col("x.properties")["GoEvidenceType"].alias("evidence"))


def flat_values(df: DataFrame, key: str, json: str, depth: int = 4) -> DataFrame:
    """Leaves of nested JSON records: full path and last name, both without other characters than letters and digits, and
    the value as text. Nesting beyond ``depth`` is kept as JSON text."""
    level = df.select(key, F.lit("").alias("path"), F.try_parse_json(json).alias("v"))
    leaves = None
    for step in range(depth):
        kind = F.schema_of_variant("v")
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        done = level.filter(~nested)
        leaves = done if leaves is None else leaves.unionByName(done)
        open_rows = level.filter(nested)
        exploded = open_rows.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
        name = F.coalesce(F.col("key"), F.lit("")) if key != "key" else F.lit("")
        level = exploded.select(open_rows[key], F.concat_ws(".", F.nullif(F.col("path"), F.lit("")), F.nullif(name, F.lit(""))).alias("path"), F.col("value").alias("v"))
    leaves = leaves.unionByName(level)
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    return leaves.select(key, plain(F.col("path")).alias("path_key"), plain(F.substring_index("path", ".", -1)).alias("leaf_key"), F.col("v").cast("string").alias("value")).filter("value is not null")

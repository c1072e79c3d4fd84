"""Feature tables: train-only statistics, scaled matrices, embeddings, projections, histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.descriptors import BITS, element_counts, fingerprint

# Fixed words that mark identifier columns.
IDENTIFIER_WORDS = ("id", "ref", "uri", "url", "name", "label", "key", "hash", "accession", "smiles", "inchi", "inchikey", "symbol")


def is_identifier(column: str) -> bool:
    """Whether a column name looks like an identifier rather than a feature."""
    return any(part in IDENTIFIER_WORDS for part in column.lower().split("_"))


#: Parts of names of descriptors that are no identifiers, whatever else is in the name.
DESCRIPTOR_WORDS = ("xlogp", "hbond", "rotatable", "heavy_atom", "atom_count", "hetero_atom", "molecular_weight", "exact_mass", "tpsa")


def is_leaking(column: str) -> bool:
    """Whether a feature's name looks like an identifier in an audit, where names of descriptors are known."""
    name = column.strip().lower()
    return is_identifier(name) and not any(word in name for word in DESCRIPTOR_WORDS)


def vector_columns(columns: list[str]) -> list[str]:
    """Columns that hold one component of a vector each."""
    import re

    return [c for c in columns if re.search(r"(?:^|_)(?:emb|fp|aa|freq)_\w+$", c)]


#: Columns whose partial statistics are merged together.
MERGED = 512
_PARTIAL = "block int, n array<double>, mean array<double>, m2 array<double>, low array<double>, high array<double>, zeros array<long>, empty array<long>, infinite array<long>, bad array<long>, rows long"


def _blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def profile(df: DataFrame, columns: list[str] | None = None, within: Column | None = None) -> DataFrame:
    """Statistics of any number of columns in one pass: feature, kind (number, text or other), rows, n (finite numbers), mean, m2 (sum of
    squared deviations), low and high of these, zeros, empty (null, NaN or blank text), infinite, bad (text that is no number).

    Moments (n to zeros) are taken over the rows where ``within`` holds, all if None; the other counts over all rows. A task reduces
    each batch of rows, as a matrix, to one partial for each column; partials are merged by blocks of columns. Numbers and texts are
    read; of others only ``empty`` is counted. No columns give no rows; of an empty table all counts are 0.
    """
    columns = df.columns if columns is None else columns
    kinds = {f.name: "number" if isinstance(f.dataType, NumericType) else "text" if f.dataType.simpleString() == "string" else "other" for f in df.schema.fields}
    value = {
        "number": lambda c: F.col(f"`{c}`").cast("double"),
        "text": lambda c: _blank(F.col(f"`{c}`")).try_cast("double"),
        "other": lambda c: F.when(F.col(f"`{c}`").isNotNull(), float("inf")),
    }
    texts = [c for c in columns if kinds[c] == "text"]
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, kind string, rows long, n long, mean double, m2 double, low double, high double, zeros long, empty long, infinite long, bad long")
    numbers = F.array(*(value[kinds[c]](c) for c in columns)).alias("v")
    given = F.array(*(_blank(F.col(f"`{c}`")).isNotNull() for c in texts)).cast("array<boolean>").alias("g")
    inner = F.lit(True) if within is None else F.coalesce(within, F.lit(False))
    at = [k for k, c in enumerate(columns) if kinds[c] == "text"]
    wide = len(columns)

    def reduce(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, wide)
            used = np.asarray(batch.column(2).to_pylist(), bool)[:, None]
            bad = np.zeros(wide, np.int64)
            empty = np.isnan(x)
            if at:
                there = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(batch.num_rows, len(at))
                wrong = there & empty[:, at]
                # The word NaN is an empty number, not a wrong one.
                bad[at] = wrong.sum(0)
                empty[:, at] &= ~there
            fine = np.isfinite(x) & used
            y = np.where(fine, x, 0.0)
            n = fine.sum(0).astype(np.float64)
            mean = y.sum(0) / np.maximum(n, 1)
            part = {
                "n": n, "mean": mean, "m2": (np.where(fine, x - mean, 0.0) ** 2).sum(0), "low": np.where(fine, x, np.inf).min(0), "high": np.where(fine, x, -np.inf).max(0),
                "zeros": (fine & (x == 0)).sum(0), "empty": empty.sum(0), "infinite": np.isinf(x).sum(0), "bad": bad, "rows": batch.num_rows,
            }
            total = part if total is None else _combined(total, part)
        if total is not None:
            for start in range(0, wide, MERGED):
                cut = {k: v if k == "rows" else v[start : start + MERGED].tolist() for k, v in total.items()}
                yield pa.RecordBatch.from_pylist([{"block": start // MERGED} | cut], schema=_partial_schema(pa))

    def merge(table):
        import numpy as np
        import pyarrow as pa

        parts = [{k: v if k in ("rows", "block") else np.array(v) for k, v in row.items()} for row in table.to_pylist()]
        total = parts[0]
        for part in sorted(parts[1:], key=lambda p: p["rows"]):
            total = _combined(total, part)
        row = {k: v if k in ("rows", "block") else v.tolist() for k, v in (total | {"block": parts[0]["block"]}).items()}
        return pa.Table.from_pylist([row], schema=_partial_schema(pa))

    partial = df.select(numbers, given, inner.alias("u")).mapInArrow(reduce, _PARTIAL).groupBy("block").applyInArrow(merge, _PARTIAL)
    zipped = F.arrays_zip("n", "mean", "m2", "low", "high", "zeros", "empty", "infinite", "bad")
    flat = partial.select("block", "rows", F.posexplode(zipped).alias("k", "c")).select((F.col("block") * MERGED + F.col("k")).alias("k"), "rows", "c.*")
    names = df.sparkSession.createDataFrame([(k, c, kinds[c]) for k, c in enumerate(columns)], "k int, feature string, kind string")
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    some = F.col("n") > 0
    return names.join(flat, "k", "left").select("feature", "kind", count("rows"), count("n"), *(F.when(some, F.col(c)).alias(c) for c in ("mean", "m2", "low", "high")), *map(count, ("zeros", "empty")), F.when(F.col("kind") == "other", 0).otherwise(count("infinite")).cast("long").alias("infinite"), count("bad"))


def _partial_schema(pa):
    real, whole = pa.list_(pa.float64()), pa.list_(pa.int64())
    fields = {"block": pa.int32()} | dict.fromkeys(("n", "mean", "m2", "low", "high"), real) | dict.fromkeys(("zeros", "empty", "infinite", "bad"), whole) | {"rows": pa.int64()}
    return pa.schema(list(fields.items()))


def _combined(a: dict, b: dict) -> dict:
    """Two partials as one; means and squared deviations without cancellation."""
    import numpy as np

    n = a["n"] + b["n"]
    share = b["n"] / np.maximum(n, 1)
    step = b["mean"] - a["mean"]
    return {
        "n": n, "mean": a["mean"] + step * share, "m2": a["m2"] + b["m2"] + step * step * a["n"] * share, "low": np.minimum(a["low"], b["low"]), "high": np.maximum(a["high"], b["high"]),
    } | {k: a[k] + b[k] for k in ("zeros", "empty", "infinite", "bad", "rows")}


def _numeric(r) -> bool:
    """A column of numbers, or of texts that are numbers where they are not blank."""
    return r.kind == "number" or r.kind == "text" and r.bad == 0 and r.empty < r.rows


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """Columns of numbers, and text columns in which every value that is not blank is a number."""
    wanted = [f.name for f in df.schema.fields if f.name not in exclude and (isinstance(f.dataType, NumericType) or f.dataType.simpleString() == "string")]
    texts = [c for c in wanted if df.schema[c].dataType.simpleString() == "string"]
    found = {r.feature for r in profile(df, texts).collect() if _numeric(r)} if texts else set()
    return [c for c in wanted if c not in texts or c in found]


def finite(column: str) -> Column:
    """A column as doubles; what is no finite number is null."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def statistics(fit: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column, in one pass."""
    return {r.feature: (r.mean or 0.0, ((r.m2 or 0.0) / max(r.n, 1)) ** 0.5) for r in profile(fit, columns).collect()}


def table_summary(tables: dict[str, DataFrame], exclude: list[str] = ("node_id",)) -> DataFrame:
    """Rows, columns, numeric and vector-like columns and missing cells (with percent) of each feature table, by one pass each."""
    out = None
    for name, df in tables.items():
        like = [c for c in df.columns if _is_component(c)]
        numeric = (F.col("kind") == "number") | ((F.col("kind") == "text") & (F.col("bad") == 0) & (F.col("empty") < F.col("rows")))
        cells = F.sum("empty").cast("long")
        one = profile(df).agg(
            F.max("rows").alias("rows"), F.count("*").alias("columns"), F.count_if(numeric & ~F.col("feature").isin(*exclude)).alias("numeric_columns"), F.lit(len(like)).cast("long").alias("vector_like_columns"),
            cells.alias("missing_cells"), F.round(100 * cells / F.greatest(F.sum("rows"), F.lit(1)), 3).alias("missing_cell_percent"),
        )
        one = one.select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _is_component(column: str) -> bool:
    import re

    return bool(re.search(r"(^|_)(fp|embedding|emb|x)_?\d+$", column))


def top_missing(tables: dict[str, DataFrame], top: int) -> DataFrame:
    """The ``top`` columns of each table with the largest percent of missing values, ties by name."""
    out = None
    for name, df in tables.items():
        share = F.round(100 * F.col("empty") / F.greatest("rows", F.lit(1)), 3)
        one = profile(df).orderBy(F.desc("empty"), "feature").limit(top).select(F.lit(name).alias("table"), "feature", share.alias("missing_percent"))
        out = one if out is None else out.unionByName(one)
    return out


def matrix_summary(tables: dict[str, DataFrame], exclude: list[str] = ("node_id",)) -> DataFrame:
    """Of each model matrix: rows, columns, numeric columns and those without (sample) variance, missing cells of all columns, and the percent of
    numeric cells that are zero or missing; by one pass each."""
    out = None
    for name, df in tables.items():
        numeric = ((F.col("kind") == "number") | ((F.col("kind") == "text") & (F.col("bad") == 0) & (F.col("empty") < F.col("rows")))) & ~F.col("feature").isin(*exclude)
        zeros = F.sum(F.when(numeric, F.col("zeros") + F.col("empty")))
        one = profile(df).agg(
            F.max("rows").alias("rows"), F.count("*").alias("columns"), F.count_if(numeric).alias("numeric_columns"),
            F.count_if(numeric & (F.coalesce(F.when(F.col("n") > 1, F.col("m2")), F.lit(0.0)) == 0)).alias("zero_variance_numeric_columns"), F.sum("empty").cast("long").alias("nan_count"),
            F.coalesce(F.round(100 * zeros / F.nullif(F.sum(F.when(numeric, F.col("rows"))), F.lit(0)), 3), F.lit(0.0)).alias("zero_numeric_cell_percent"),
        )
        one = one.select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def top_variance(df: DataFrame, columns: list[str], top: int) -> DataFrame:
    """The ``top`` columns by sample variance, ties by name."""
    variance = F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1))
    return profile(df, columns).select("feature", variance.alias("variance")).orderBy(F.desc_nulls_last("variance"), "feature").limit(top)


def model_matrix(rows: DataFrame, keys: list[str], fit: DataFrame | None = None, prefix: str = "x_") -> DataFrame:
    """Keys with ``x_*`` (centred and scaled by the statistics of the ``fit`` rows, mean where missing) and
    ``missing_*``. ``fit(keys)`` are the training rows, all if None. Identifier columns are left out; a column without
    spread is only centred."""
    columns = [c for c in numeric_columns(rows, keys) if not is_identifier(c)]
    stats = statistics(rows if fit is None else rows.join(fit.select(*keys).distinct(), keys, "left_semi"), columns)
    scaled = {}
    for c in columns:
        mean, spread = stats[c]
        value = finite(c)
        scaled[f"{prefix}{c}"] = (F.coalesce(value, F.lit(mean)) - F.lit(mean)) / F.lit(spread if spread > 0 else 1.0)
        scaled[f"missing_{c}"] = value.isNull().cast("int")
    return rows.select(*keys, *(c.alias(name) for name, c in scaled.items()))


def with_zscores(rows: DataFrame, keys: list[str], fit: DataFrame | None = None) -> DataFrame:
    """All columns, with ``z_*`` and ``z_*_missing`` of the numeric ones."""
    matrix = model_matrix(rows, keys, fit, prefix="z_")
    names = [c for c in matrix.columns if c.startswith("missing_")]
    renamed = matrix.withColumnsRenamed({c: f"z_{c.removeprefix('missing_')}_missing" for c in names})
    return rows.join(renamed, keys)


def descriptor_rows(compounds: DataFrame, key: str, formula: str, structure: str, method: str = "hashed_ngrams_v1") -> DataFrame:
    """One row for each compound that has a formula or a structure text (the first of repeated keys by these): repr_id, the key, method, element
    counts of the formula, how many atoms and elements these are, and the on-bits and density of the structure's fingerprint."""
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    given = compounds.select(key, text(formula).alias("formula"), text(structure).alias("structure")).filter(F.col(key).isNotNull() & F.coalesce("formula", "structure").isNotNull())
    first = given.groupBy(key).agg(F.min(F.struct("formula", "structure")).alias("_r")).select(key, "_r.*")
    counts = element_counts("formula")
    bits = F.when(F.col("structure").isNotNull(), fingerprint("structure"))
    rows = first.select(key, "structure", counts.alias("elements"), bits.alias("bits"))
    return rows.select(
        F.concat(F.lit("molgraph:"), F.col(key).cast("string"), F.lit(f":{method}")).alias("repr_id"), key, F.lit(method).alias("method"), "elements",
        F.aggregate(F.map_values("elements"), F.lit(0).cast("long"), lambda s, x: s + x).alias("n_atoms"), F.size("elements").alias("n_elements"),
        "bits", F.round(F.size("bits") / BITS, 6).alias("bit_density"),
    )


def embedding_columns(rows: DataFrame, key: str, method: str, vector: str, size: int, methods: list[str]) -> DataFrame:
    """One row a node: the first ``size`` components of each method's vector as columns ``<method>_<i>``."""
    parts = [F.max(F.when(F.col(method) == m, F.get(vector, F.lit(i)))).alias(f"{m}_{i:04d}") for m in methods for i in range(size)]
    return rows.groupBy(key).agg(*parts)


def unpivoted(df: DataFrame, columns: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """One row for each column's value, as double."""
    pairs = F.array(*(F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value)) for c in columns))
    return df.select(F.explode(pairs).alias("_p")).select(f"_p.{name}", f"_p.{value}")


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, min, median, mean and max of each column; infinities count as missing."""
    finite = unpivoted(df, columns).withColumn("value", F.when(F.abs("value") < float("inf"), F.col("value")))
    return finite.groupBy("feature").agg(F.count("value").alias("n"), F.min("value").alias("min"), F.median("value").alias("median"), F.avg("value").alias("mean"), F.max("value").alias("max"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value, with one that is not zero, and without, of each column."""
    found = unpivoted(df, columns).groupBy("feature").agg(F.count("value").alias("n_present"), F.count_if(F.col("value") != 0).alias("n_nonzero"), F.count_if(F.col("value").isNull()).alias("n_missing"), F.count("*").alias("n_rows"))
    return found.withColumn("percent_present", F.round(100 * F.col("n_present") / F.col("n_rows"), 3))


def matrix_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sample variance, missing values and percent of zeros of each column, and whether it is constant."""
    found = unpivoted(df, columns).groupBy("feature").agg(F.var_samp("value").alias("variance"), F.count_if(F.col("value").isNull() | F.isnan("value")).alias("n_missing"), F.round(100 * F.avg(F.coalesce((F.col("value") == 0).cast("int"), F.lit(0))), 3).alias("percent_zero"))
    return found.withColumn("constant", F.coalesce(F.col("variance") == 0, F.lit(True)))


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns, by one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    cells = df.agg(*(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c_{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c_{i}").alias("r")) for i, (a, b) in enumerate(pairs)))
    return cells.select(F.explode(rows).alias("_c")).select("_c.a", "_c.b", "_c.r")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows of each of ``bins`` equal bins of [low, high); 0 and bins + 1 are below and above."""
    bin_of = F.width_bucket(F.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins))
    return df.filter(F.col(column).isNotNull()).groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, category: str, value: str) -> DataFrame:
    """Five-number summary of a value by category."""
    points = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return df.groupBy(category).agg(*(F.percentile(value, p).alias(name) for name, p in points.items()), F.count(value).alias("n"))


def principal_components(df: DataFrame, key: str, columns: list[str], k: int = 2) -> DataFrame:
    """Projection on the first ``k`` principal components of the standardised columns, medians where missing. The
    sign of a component is arbitrary."""
    from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    numbers = df.select(key, *(F.col(c).cast("double").alias(c) for c in columns))
    filled = Imputer(inputCols=columns, outputCols=columns, strategy="median").fit(numbers).transform(numbers)
    vectors = VectorAssembler(inputCols=columns, outputCol="raw").transform(filled)
    scaled = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True).fit(vectors).transform(vectors)
    found = PCA(k=k, inputCol="scaled", outputCol="pc").fit(scaled).transform(scaled)
    array = vector_to_array("pc")
    return found.select(key, *(array[i].alias(f"pc{i + 1}") for i in range(k)))


def any_present(*columns: str) -> Column:
    """Whether one of several alias columns has a value that is not blank."""
    return reduce(lambda a, b: a | b, (F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNotNull() for c in columns))

"""Embedding whitening by a covariance weighted with multiplicities (operator 11).

Entries c of a vector become whole numbers x = floor(64 c) + 1,000,000. Equal x vectors are one row with its count; the means and the
centred covariance are sums over these rows, weighted with the counts (or with one each). Components are unit eigenvectors of the
covariance by falling eigenvalue; the entry of each with the largest absolute value is positive. Each distinct vector is projected
once and joined back to its rows.

Rows whose vector is null or holds null or non-finite entries go. Vectors of another length are whitened among themselves; an empty
vector has no components. 64 c beyond +-2**53 counts as that bound. Where x does not vary along a component (a table of fewer distinct
vectors than components) the eigenvalue is 0: whitened and explained are 0 there, and identity_error leaves the component out.
Repeated ids are rows of their own. An empty table gives no rows.

Sums of tasks are added up by Spark; only one sum for each pair of dimensions comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import column
from .storage import transient_shuffles, written

BIAS, LIMIT = 1_000_000, float(1 << 53)
NEW = ("n", "deviation", "whitened", "explained", "identity_error")


def usable(vector: Column) -> Column:
    """Neither null nor with null, NaN or infinite entries."""
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    return F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(F.least(F.greatest(c * 64.0, F.lit(-LIMIT)), F.lit(LIMIT))) + F.lit(BIAS).cast("long"))


def _matrices(batch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length of vector, and their vectors as a matrix."""
    lists = column(batch, name)
    size = np.diff(np.asarray(lists.offsets))
    values = np.asarray(lists.flatten())
    start = np.cumsum(size) - size
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        yield rows, values[start[rows, None] + np.arange(length)]


def _totals(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length of vector the number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            weight = np.asarray(column(batch, "w"), np.int64)
            for rows, x in _matrices(batch, "x"):
                w, y = weight[rows], x - BIAS
                n = int(w.sum())
                if n * int(np.abs(y).max(initial=0)) >= 1 << 62:
                    w, y = w.astype(object), y.astype(object)
                before = sums.get(x.shape[1], (0, np.zeros(x.shape[1], object)))
                sums[x.shape[1]] = before[0] + n, before[1] + (w @ y).astype(object) + n * BIAS
        found = [(size, place, n, Decimal(int(s))) for size, (n, each) in sums.items() for place, s in enumerate([0, *each], -1)]
        columns = list(zip(*found)) or [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["size", "place", "n", "s"])

    each = distinct.mapInArrow(run, "size int, place int, n long, s decimal(38, 0)").groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in each.orderBy("size", "place").collect():
        found.setdefault(r.size, (r.n, []))[1].extend([int(r.s)] if r.place >= 0 else [])
    return found


class Centre:
    """Deviations from the mean S / n: a whole number and the rest, so that nothing cancels."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.near = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.near)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.near, np.int64)).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)**2; null where that is beyond a long."""
        about = ((self.n * self.centred(x)) ** 2).sum(axis=1)
        if about.max(initial=0) < 1e18:
            d = self.n * (x - np.array(self.near, np.int64)) - np.array(self.rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        found: list[int | None] = []
        for row, size in zip(x.tolist(), about.tolist()):
            exact = sum((self.n * (v - m) - r) ** 2 for v, m, r in zip(row, self.near, self.rest)) if size < 1e19 else 1 << 63
            found.append(exact if exact < 1 << 63 else None)
        return found


def _products(rows: DataFrame, name: str, centre) -> dict[int, np.ndarray]:
    """The weighted sums of centred vectors (first row) and of their outer products, by length."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = np.asarray(column(batch, "w"), np.float64)
            for at, x in _matrices(batch, name):
                y, w = centre(x), weight[at]
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + np.vstack([w @ y, (y * w[:, None]).T @ y])
        found = [(size, i, values.tolist()) for size, each in sums.items() for i, values in enumerate(each)]
        columns = list(zip(*found)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.list_(pa.float64())))], names=["size", "i", "p"])

    def added(table):
        import pyarrow as pa

        total = np.sum([np.asarray(v.values) for v in table.column("p").combine_chunks()], axis=0)
        return pa.table({"size": table.column("size")[:1], "i": table.column("i")[:1], "p": pa.array([total.tolist()], pa.list_(pa.float64()))})

    schema = "size int, i int, p array<double>"
    each = rows.mapInArrow(run, schema).groupBy("size", "i").applyInArrow(added, schema)
    found: dict[int, list[tuple[int, list[float]]]] = {}
    for r in each.collect():
        found.setdefault(r.size, []).append((r.i, r.p))
    return {size: np.array([p for _, p in sorted(each)]).reshape(len(each), size) for size, each in found.items()}


class Basis:
    """Components of a covariance: ``vectors`` divided by the root of their eigenvalues (0 without variance)."""

    def __init__(self, covariance: np.ndarray, most: int):
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2) if len(covariance) else (np.zeros(0), np.zeros((0, 0)))
        values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
        top = values.max(initial=0)
        self.varies = values > top * len(covariance) * np.finfo(float).eps
        if len(values):
            vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        trace = np.trace(covariance)
        self.explained = np.where(self.varies, values / trace if trace > 0 else 0.0, 0.0).tolist()
        self.scaled = vectors / np.sqrt(np.where(self.varies, values, np.inf))


def whitened(df: DataFrame, vector: str = "embedding", components: int = 32, weights: str = "counts", keep: list[str] | None = None) -> DataFrame:
    """The usable rows of ``df`` (or their columns ``keep``) with n (weight of the fit list), deviation (exact sum over dimensions of
    (n x - S)**2; null beyond a long), whitened and explained (arrays by component, at most ``components``) and identity_error (largest
    absolute entry of the covariance of whitened minus the identity). Columns of these names are replaced. ``weights`` is "counts" or
    "one": each distinct vector weighs as much as it has rows, or one."""
    if weights not in ("counts", "one"):
        raise ValueError('weights are "counts" or "one"')
    keep = [c for c in (df.columns if keep is None else keep) if c not in NEW]
    inner = "_" * (1 + max([0, *map(len, keep)])) + "x"
    source = df.filter(usable(F.col(f"`{vector}`"))).select(*(F.col(f"`{c}`") for c in keep), whole_numbers(F.col(f"`{vector}`")).alias(inner))
    with transient_shuffles(df.sparkSession):
        distinct = written(source.groupBy(F.col(inner).alias("x")).agg((F.count("*") if weights == "counts" else F.lit(1).cast("long")).alias("w")), "whitening-vectors")
        centres = {size: Centre(n, sums) for size, (n, sums) in _totals(distinct).items()}
        products = _products(distinct, "x", lambda x: centres[x.shape[1]].centred(x))
        bases = {size: Basis(p[1:] / centres[size].n, components) for size, p in products.items()}

        def project(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for rows, x in _matrices(batch, "x"):
                    centre = centres[x.shape[1]]
                    y = centre.centred(x) @ bases[x.shape[1]].scaled
                    offsets = pa.array(np.arange(len(rows) + 1) * y.shape[1], pa.int32())
                    kept = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [column(kept, "x"), column(kept, "w"), pa.array(centre.deviation(x), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))], names=["x", "w", "deviation", "whitened"]
                    )

        projected = written(distinct.mapInArrow(project, "x array<long>, w long, deviation long, whitened array<double>"), "whitening-projected")
        # By the number of components: lengths that share it are told apart by the length of x.
        facts = []
        for size, centre in centres.items():
            basis = bases[size]
            got = _products(projected.filter(F.size("x") == size), "whitened", lambda y: y)
            width = len(basis.explained)
            p = got.get(width, np.zeros((width + 1, width))) / centre.n
            off = np.abs(p[1:] - np.outer(p[0], p[0]) - np.eye(width))[np.ix_(basis.varies, basis.varies)]
            facts.append((size, centre.n, basis.explained, float(off.max(initial=0))))
    # One row a length of vector.
    about = F.broadcast(df.sparkSession.createDataFrame(facts, "size int, n long, explained array<double>, identity_error double"))
    each = projected.drop("w").withColumn("size", F.size("x")).join(about, "size").drop("size").withColumnRenamed("x", f"{inner}2")
    return source.join(each, F.col(inner) == F.col(f"{inner}2")).select(*(F.col(f"`{c}`") for c in keep), *NEW)

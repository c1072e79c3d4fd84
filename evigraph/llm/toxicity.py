"""Toxicity grades by cumulative-link ordinal regression (operator 6).

P(grade >= k) is the logistic function of ``weights . features - threshold[k]``: one weight for each feature, shared by
all thresholds, which rise with k. Features are the words of the lower-cased text (runs of letters) and their
first PREFIX characters, present or not, hashed to BUCKETS; those in fewer than MIN_DOCUMENTS sampled texts have
weight 0. The fit minimises the likelihood with an L1 penalty by accelerated proximal gradient.

The model is fitted on a bounded sample of the labelled rows: about SAMPLE of them, by a hash of their id; it is
the only thing that is. A null or empty text has no features. A grade that no row has adds no threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField

from .arrow import column, with_computed
from .wordhash import prefix_sums, span_hashes, text_bytes

SAMPLE = 10_000
BUCKETS = 1 << 20
MIN_DOCUMENTS = 2
PREFIX = 5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def features(text) -> tuple[np.ndarray, np.ndarray]:
    """Of an Arrow column: (row, bucket) of each feature that a row has, by row."""
    import pyarrow.compute as pc

    data, offsets = text_bytes(pc.utf8_lower(text))
    inside = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    character = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(character, start)
    character = np.append(character, [len(data)] * (PREFIX + 1))
    cut = np.minimum(character[first + PREFIX], end)
    sums = prefix_sums(data)
    words, stems = span_hashes(sums, start, end), span_hashes(sums, start, cut)
    row = np.searchsorted(offsets, start, side="right") - 1
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    half = np.uint64(BUCKETS // 2)
    bucket = np.concatenate([(words >> shift) % half, (stems >> shift) % half + half]).astype(np.int64)
    key = np.unique(np.concatenate([row, row]) * BUCKETS + bucket)
    return key // BUCKETS, key % BUCKETS


class OrdinalModel:
    """Weights by bucket and ascending thresholds of grades[1:]."""

    def __init__(self, grades: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def at_least(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= grades[k]) of n rows, for k from 1 on."""
        score = np.bincount(row, weights=self.weights[bucket], minlength=n)
        return 1 / (1 + np.exp(np.clip(self.thresholds - score[:, None], -60, 60)))


def fit(row: np.ndarray, bucket: np.ndarray, grade: np.ndarray, penalty: float = 0.5, rounds: int = 150) -> OrdinalModel:
    """Fit on sparse rows. ``penalty`` is the L1 weight in log-likelihood of one row."""
    grades = np.unique(grade)
    n, levels = len(grade), len(grades) - 1
    weights = np.zeros(BUCKETS)
    if levels < 1:
        return OrdinalModel(grades, weights, np.zeros(0))
    frequent = np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(frequent >= MIN_DOCUMENTS)
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    keep = place[bucket] >= 0
    row, feature = row[keep], place[bucket][keep]
    rank = np.searchsorted(grades, grade)
    share = np.array([np.mean(rank >= k) for k in range(1, levels + 1)])
    theta = -np.log(share / (1 - share))

    def gradient(w, t):
        """Of the negative log-likelihood: probabilities of the grades are differences of the cumulative ones."""
        score = np.bincount(row, weights=w[feature], minlength=n)
        above = 1 / (1 + np.exp(np.clip(t - score[:, None], -60, 60)))
        cumulative = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = cumulative * (1 - cumulative)
        at = np.arange(n)
        p = np.maximum(cumulative[at, rank] - cumulative[at, rank + 1], 1e-12)
        by_score = -(slope[at, rank] - slope[at, rank + 1]) / p
        by_theta = np.zeros(levels)
        for k in range(levels):
            by_theta[k] = (slope[rank == k + 1, k + 1] / p[rank == k + 1]).sum() - (slope[rank == k, k + 1] / p[rank == k]).sum()
        return np.bincount(feature, weights=by_score[row], minlength=len(used)), by_theta

    # A feature's curvature is at most a quarter of the rows that have it, times the features of a row.
    width = np.bincount(row, minlength=n)
    curve = 0.25 * np.bincount(feature, weights=width[row].astype(float), minlength=len(used)) + 1e-9
    step = 1 / np.sqrt(curve * 0.25 * np.maximum(frequent[used], 1))
    w, w_last, t = np.zeros(len(used)), np.zeros(len(used)), theta.copy()
    for k in range(rounds):
        point = w + k / (k + 3) * (w - w_last)
        by_w, by_t = gradient(point, t)
        moved = point - step * by_w
        w_last, w = w, np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        t = np.maximum.accumulate(t - 2.0 * by_t / n)
    weights[used] = w
    return OrdinalModel(grades, weights, t)



def fitted(graded: DataFrame, docs: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    """Fit on about ``sample`` rows of ``graded(doc_id, grade)`` and the texts of ``docs``; features are made on
    the executors, and only those of the sample come to the driver."""
    known = graded.filter("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    rows = known.count()
    share = min(1.0, sample / max(1, rows))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most about ``sample`` ids and grades.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def make():
        import pyarrow as pa

        def compute(batch):
            row, bucket = features(column(batch, "text"))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(batch)))])
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))]

        return compute

    found = with_computed(texts, [StructField("buckets", ArrayType(IntegerType()))], make, keep=["doc_id", "grade"]).toArrow().combine_chunks()
    if not len(found):
        return OrdinalModel(np.zeros(1, np.int64), np.zeros(BUCKETS), np.zeros(0))
    lists = found.column("buckets").combine_chunks()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return fit(row, lists.flatten().to_numpy().astype(np.int64), found.column("grade").to_numpy().astype(np.int64))


FIELDS = [StructField("severity", DoubleType()), StructField("grade", IntegerType()), StructField("toxic", BooleanType())]


def with_severity(docs: DataFrame, model: OrdinalModel, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the expected grade ``severity``, the median grade and ``toxic``
    (a grade above the lowest is at least as likely as not)."""
    used = np.flatnonzero(model.weights)
    shared = docs.sparkSession.sparkContext.broadcast((model.grades, used, model.weights[used], model.thresholds))  # BUCKETS at most

    def make():
        import pyarrow as pa

        grades, places, values, thresholds = shared.value
        weights = np.zeros(BUCKETS)
        weights[places] = values
        own = OrdinalModel(grades, weights, thresholds)

        def compute(batch):
            row, bucket = features(column(batch, "text"))
            above = own.at_least(row, bucket, len(batch))
            severity = grades[0] + above @ np.diff(grades)
            level = (above >= 0.5).sum(axis=1)
            return [pa.array(severity.astype(float)), pa.array(grades[level].astype(np.int32)), pa.array(level > 0)]

        return compute

    return with_computed(docs, FIELDS, make, keep)

"""Whitening, conversation repair and backoff scores against brute force on small, awkward tables."""

from __future__ import annotations

import collections
import hashlib
import heapq
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evigraph.llm import conversations, jaccard_join, katz, queries, suffix_dedup, whitening

from ..conftest import SF
from .test_operators import awkward, table

# --- whitening -------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, n string, x string, `a.b` int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], "own", "x", 1) for i, v in enumerate(rows)], VECTORS).repartition(3)


def whole(v):
    return [math.floor(64 * c) + 1_000_000 for c in v]


def check_whitened(found, rows, components=32, weights="counts"):
    """Against numpy on the expanded fit list; components by their eigenvalue, signs by the largest entry."""
    usable = [(i, whole(v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = [x for _, x in usable] if weights == "counts" else [list(x) for x in {tuple(x) for _, x in usable}]
    x = np.array(fit, object)
    n, sums = len(fit), x.sum(axis=0)
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in fit], float)
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1][:components]
    assert sorted(r.vec_id for r in found) == sorted(i for i, _ in usable)
    projected = {}
    for r in found:
        vector = dict(usable)[r.vec_id]
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(vector, sums))
        assert len(r.whitened) == len(r.explained) == min(components, len(sums))
        assert np.allclose(r.explained, np.where(values > 1e-9 * values[0], values / np.trace(covariance), 0), rtol=1e-6, atol=1e-12)
        assert r.identity_error <= 1e-4
        projected[tuple(vector)] = r.whitened
    varies = values > 1e-9 * values[0]
    y = np.array([projected[tuple(v)] for v in fit])[:, varies]
    assert np.allclose(y.T @ y / n, np.eye(varies.sum()), atol=1e-6)
    # Back to the covariance: the whitened values times the root of the eigenvalue are projections on orthonormal vectors.
    basis = np.linalg.lstsq(centred, y * np.sqrt(values[varies]), rcond=None)[0]
    assert np.allclose(covariance @ basis, basis * values[varies], atol=1e-6 * values[0])


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening(spark, weights):
    rng = np.random.default_rng(3)
    rows = [rng.normal(size=6).tolist() for _ in range(40)]
    rows += [rows[0]] * 30 + [None, [1.0, None, 0, 0, 0, 0], [math.nan] * 6, [math.inf, 0, 0, 0, 0, 0]]
    found = whitening.whitened(vectors(spark, rows), weights=weights)
    assert found.columns == ["vec_id", "embedding", "x", "a.b", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(found.collect(), list(enumerate(rows)), weights=weights)


def test_whitening_without_variance_and_lengths(spark):
    rows = [[1.0, 2.0, 3.0]] * 3 + [[0.5, 0.5]] * 2 + [[1.5, 0.5], []]
    found = {r.vec_id: r for r in whitening.whitened(vectors(spark, rows)).collect()}
    assert found[0].whitened == [0, 0, 0] and found[0].explained == [0, 0, 0] and found[0].n == 3 and found[0].deviation == 0
    assert found[3].n == 3 and found[3].explained == [1, 0] and abs(found[5].whitened[0]) == pytest.approx(math.sqrt(2))
    assert found[6].whitened == [] and found[6].n == 1
    assert whitening.whitened(vectors(spark, [])).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [[3e38, 1.0], [1.0, 2.0], [2.0, -1e300]]
    found = whitening.whitened(vectors(spark, rows)).collect()
    assert len(found) == 3 and all(r.deviation is None and all(map(math.isfinite, r.whitened)) for r in found)


def test_whitening_query(spark):
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    found = collections.defaultdict(list)
    for r in queries.op11_whitening(spark, SF).orderBy("component").collect():
        found[r.vec_id].append(r)
    Row = collections.namedtuple("Row", "vec_id n deviation whitened explained identity_error")
    check_whitened([Row(i, e[0].n, e[0].deviation, [r.whitened for r in e], [r.explained for r in e], e[0].identity_error) for i, e in found.items()], list(rows.items()))


# --- conversations ---------------------------------------------------------------------------------------------------


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repair(rows):
    """Report of one conversation's damaged rows: least (cost, audit) first, by a search over (rows used, state)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:32], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    steps = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, out = heapq.heappop(heap)
        if (i, q) in done:
            continue
        if i == len(rows) and q in (0, 3):
            break
        done.add((i, q))
        for letter, role in (("u", "user"), ("a", "assistant")):
            if (letter, q) in steps:
                heapq.heappush(heap, (cost + 3, audit + "I", i, steps[letter, q], (*out, f"{role}:")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q, out))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                if (role[:1], q) in steps:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, steps[role[:1], q], (*out, f"{role}:{text}")))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if (letter, q) in steps:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, steps[letter, q], (*out, f"{name}:{text}")))
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


CONVERSATION = "conv_id long, turn long, role string, text string, audit string, `a.b` int, at string"


def check_repairs(found, rows, convs):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found}
    assert set(found) == set(convs)
    for conv in convs:
        assert found[conv] == repair(groups[conv]), conv


def talk(seed, n):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "No!", "what", "", " \n", None, "So?  ", "é ü.", "x" * 40 + "a.", "x" * 40 + "b."]
    return [(None if rng.random() < 0.1 else int(rng.integers(0, n + 2)), roles[rng.integers(len(roles))], texts[rng.integers(len(texts))]) for _ in range(n)]


@pytest.mark.parametrize("block", [1024, 4])
def test_conversation_repair(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = [(conv, *r) for conv in range(60) for r in talk(conv, conv % 9)]
    rows += [(None, *r) for r in talk(99, 6)] + [(200, *r) for r in talk(7, 120)] + [(201, 1, "user", "Same.")] * 50
    df = spark.createDataFrame([(*r, "own", 1, "own") for r in rows], CONVERSATION).repartition(3)
    convs = {r[0] for r in rows}
    check_repairs(conversations.repaired(df).collect(), [tuple(" " if v is None and k > 1 else v for k, v in enumerate(r)) for r in rows], convs)
    check_repairs(conversations.repaired(conversations.damaged(df), df).collect(), damage(rows), convs)
    assert conversations.repaired(df.limit(0)).count() == 0


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check_repairs(queries.op12_conversation_repair(spark, SF).collect(), damage(rows), {r[0] for r in rows})


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "system", "End."), (2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, "own", 1, "own") for r in rows], CONVERSATION)
    found = [tuple(r) for r in conversations.repaired_turns(df).orderBy("conv_id", "place").collect()]
    assert found == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "End.")]


def test_cells_do_not_depend_on_the_split():
    kinds = [("u", ""), ("a", "truncated"), ("s", ""), ("x", "duplicate"), ("u", "truncated")]
    for rows in itertools.product(kinds, repeat=3):
        a, b, c = (conversations.row_cell(*r) for r in rows)
        assert conversations.joined(conversations.joined(a, b), c) == conversations.joined(a, conversations.joined(b, c))


# --- backoff scores --------------------------------------------------------------------------------------------------


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})), None]


class Model:
    """Katz backoff of order 2 over dictionaries."""

    def __init__(self, texts):
        self.one, self.two = collections.Counter(), collections.Counter()
        for text in texts:
            words = tokens_of(text)
            self.one.update(words)
            self.two.update(zip(["start", *((w,) for w in words)], words))
        self.n = sum(self.one.values())
        self.context = collections.Counter()
        for (h, _), c in self.two.items():
            self.context[h] += c
        self.d1, self.d2 = (self.discount(collections.Counter(x.values())) for x in (self.one, self.two))
        self.unseen = 1 - sum(self.d1(c) * c for c in self.one.values()) / self.n if self.n else 1.0
        self.left = {}
        every = collections.defaultdict(dict)
        for (h, w), c in self.two.items():
            every[h][w] = c
        for h, total in self.context.items():
            after = every[h]
            self.left[h] = (1 - sum(self.d2(c) * c for c in after.values()) / total) / (1 - sum(self.p1(w) for w in after))

    @staticmethod
    def discount(kinds):
        r = sorted(kinds)
        slope = -2.0
        if len(r) > 1:
            gaps = [(b - a) / 2 for a, b in zip([0, *r[:-1]], [*r[1:], 2 * r[-1] - r[-2]])]
            slope = min(-1.05, np.polyfit(np.log(r), np.log([kinds[c] / g for c, g in zip(r, gaps)]), 1)[0])

        def d(c):
            turing = (c + 1) * kinds[c + 1] / (c * kinds[c])
            return turing if c <= 5 and 0 < turing < 1 else (1 + 1 / c) ** (slope + 1)

        return d

    def p1(self, w):
        c = self.one[w]
        return self.d1(c) * c / self.n if c else self.unseen

    def p(self, h, w):
        c = self.two[h, w]
        return self.d2(c) * c / self.context[h] if c else self.left.get(h, 1.0) * self.p1(w)

    def score(self, text):
        words = tokens_of(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip(["start", *((w,) for w in words)], words))


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 300, "entries": 40, "split": 20}])
def test_katz_scores(spark, sizes):
    """The smaller sizes make many chunks and buckets, and split contexts."""
    texts = awkward() + ["the cat sat on the mat", "The cat ate the rat.", "the the the the", "a b\x00 b\x00\x00 " + "b" * 15 + " " + "b" * 16 + " " + "b" * 300] * 8
    docs = table(spark, texts)
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    model = Model([t for t, k in zip(texts, train) if k])
    found = katz.scored(docs.withColumn("score", F.lit("own")), ~katz.held_out(F.col("doc_id")), **sizes).collect()
    assert len(found) == len(texts)
    for r in found:
        words = tokens_of(texts[r.doc_id])
        assert (r.text, r.n_tokens, r.train_tokens) == (texts[r.doc_id], len(words), model.n)
        assert r.n_known == sum(model.one[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in words), rel=1e-9)
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), rel=1e-9)
    for h in list(model.context)[::7] + [("never",)]:
        assert sum(model.p(h, w) for w in model.one) + model.p(h, ("unseen",)) == pytest.approx(1)


def test_katz_scores_without_rows_or_training(spark):
    assert katz.scored(table(spark, ["a"]).limit(0), F.lit(True)).count() == 0
    found = katz.scored(table(spark, ["a b", None]), F.lit(None).cast("boolean"), keep=["doc_id"]).collect()
    assert sorted(tuple(r) for r in found) == [(0, 3, 0, 0, 0.0, 0.0), (1, 1, 0, 0, 0.0, 0.0)]


def test_katz_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs}
    model = Model([r.text for r in docs if not held[r.doc_id]])
    texts = {r.doc_id: r.text for r in docs}
    found = queries.op13_katz_scores(spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.held_out == held[r.doc_id] and r.train_tokens == model.n
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), rel=1e-9)
    # The model has learnt something: texts that it has not seen are likelier than under the base.
    assert sum(r.score for r in found if r.held_out) > sum(r.base_score for r in found if r.held_out)


# --- what earlier operators hold -------------------------------------------------------------------------------------


def test_region_pairs_are_given_in_bounded_batches(monkeypatch):
    """5,000 sets that the histograms can't tell apart: 12 million candidate pairs, about PAIRS of them at a time."""
    monkeypatch.setattr(jaccard_join, "PAIRS", 50_000)
    one = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    n = 5_000
    region = jaccard_join.Region(np.arange(n), np.full(n, len(one)), np.arange(n), [jaccard_join.histogram(np.sort(one))] * n)
    total = 0
    for rows in region.pairs():
        assert len(rows) <= 50_000 + n
        total += len(rows)
    assert total == n * (n - 1) // 2


def test_copies_that_share_a_passage(spark):
    """10,000 copies of a text, and a passage of it in 2,000 other texts: spans of a text are gathered once, and every text keeps
    what is its own."""
    passage = "".join(chr(97 + k * k % 26) for k in range(300))
    copied = "own start " + passage + " own end."
    texts = [copied] * 10_000 + [f"{k} " + passage + f" {k}" for k in range(2_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.removal_digests(df).collect()}
    assert len(found) == len(texts)
    for k, text in enumerate(texts):
        if k < 10_000:
            assert found[k] == (len(text), len(text), 1)
        else:
            # A blank on both sides of the passage is shared as well.
            assert found[k][0] == len(text) and found[k][1] >= 300 and found[k][1] <= 300 + 2 + 2 * 4 and found[k][2] == 1

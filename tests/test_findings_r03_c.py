"""What the third round's findings of growth asked for: each of these failed before."""

from __future__ import annotations

import itertools
import random

from evigraph import queries
from evigraph.llm import jaccard_join
from evigraph.operators import cooccurrence

from .conftest import SF


def test_rows_of_resources_are_combined_last(spark):
    """All rows of all resources of a target were combined, made distinct and shuffled before the first were taken."""
    dice = random.Random(7)
    triples = []
    for k in range(40):
        cooc = f"cooccurrence:{k}"
        for kind, most in {"compound": 3, "protein": 3, "gene": 2, "disease": 2, "reference": 3}.items():
            triples += [(cooc, "x:about", f"{kind}:{dice.randrange(6)}") for _ in range(dice.randrange(most + 1))]
        triples += [(f"protein:{dice.randrange(4)}", "x:in", cooc), (cooc, "x#score", str(k % 5)), (cooc, "x#score", "none")]
    targets = [("protein:0",), ("protein:1",), ("protein:1",), ("gene:2",), ("disease:3",)]
    kept = [("compound:1",), ("compound:4",), ("compound:4",)]
    spread = spark.createDataFrame(triples * 2, "s string, p string, o string")
    wanted, listed = spark.createDataFrame(targets, "target string"), spark.createDataFrame(kept, "compound string")

    def plain(per_target, per_pair, compounds):
        low = lambda r: tuple((x is not None, x or "") for x in r)
        rows = {}
        for t in {t for (t,) in targets}:
            for c in {s for s, _, o in triples if o == t and s.startswith("cooc")} | {o for s, _, o in triples if s == t and o.startswith("cooc")}:
                of = lambda kind: sorted({o for s, _, o in triples if s == c and o.startswith(f"{kind}:")})  # noqa: B023, E731
                mine = [x for x in of("compound") if not compounds or (x,) in kept]
                if compounds and not mine:
                    continue
                ends = [mine or [None], of("protein") or [t if t.startswith("protein:") else None], of("gene") or [t if t.startswith("gene:") else None], of("disease") or [None], of("reference") or [None]]
                rows.setdefault(t, []).extend((f"cooc:{c[13:]}", *e) for e in itertools.product(*ends))
        first = {}
        for t in sorted(rows):
            pairs, found = {}, sorted(rows[t], key=low)[:per_target]
            for r in sorted(found, key=lambda r: (r[5] is None, low(r))):
                pair = (r[1], r[2] or r[3] or t)
                pairs[pair] = pairs.get(pair, 0) + 1
                if r[5] is None or per_pair is None or pairs[pair] <= per_pair:
                    first.setdefault(r, t)
        return sorted(((t, *r, float(int(r[0][5:]) % 5)) for r, t in first.items()), key=low)

    low = lambda r: tuple((x is not None, x or "") for x in r)
    for per_target, per_pair, compounds in ((1, 2, None), (7, 2, listed), (30, None, None), (None, 2, listed)):
        found = cooccurrence.cooccurrences(spread, wanted, compounds, per_target=per_target, per_pair=per_pair)
        rows = found.select("target", *cooccurrence.KEY, "score").collect()
        assert sorted(map(tuple, rows), key=low) == plain(per_target, per_pair, compounds is not None)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1


def test_regions_are_dealt_once(spark):
    """Shingles were shuffled to count the documents of each region, and again to be joined with the counts."""
    rows = spark.range(300).selectExpr("explode(array(id, id % 40 + 1000)) AS region", "id AS node", "id % 7 AS size")
    found = jaccard_join._shared(rows)
    assert sorted((r.region, r.node, r.pivot) for r in found.collect()) == sorted((k % 40 + 1000, k, k % 40) for k in range(300))
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_validated_pairs_take_ends_only(spark):
    """Ids and labels of measurements were made, shuffled and made distinct, of which only the pair was kept."""
    plan = queries.QUERIES["j24_validated_pairs"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan

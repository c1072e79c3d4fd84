"""Training-data operators against brute force on small, awkward tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evigraph.llm import bpe_codec, decontaminate, html_extract, jaccard_join, language_id, quality_rules, suffix_dedup, token_counts, token_output, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, severity string, size int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = [f"w{i % 97}x{i % 89}" for i in range(400)]


def table(spark, texts, ids=None):
    """Texts as documents with null columns and columns that clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "s1", None, "own", 7) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA).withColumn("a.b", F.lit(1)).repartition(3)


def awkward():
    """Null, empty, blank, tiny, repeated, near copies, a long text, other scripts."""
    near = BASE.copy()
    near[200] = "changed"
    far = BASE.copy()
    far[::20] = ["other"] * len(far[::20])
    texts = [None, "", " \n\t ", "one", "one", "Two words", "a b c d e", "A b c d E", " ".join(BASE), " ".join(near), " ".join(far), " ".join(BASE).upper()]
    texts += ["".join(chr(0x4E00 + i % 500) for i in range(300)) + " é ü ñ 　 x", "ab" * 300, "x" * 999, "y" * 199, " ".join(BASE * 3), "loop loop loop\nloop loop loop\n\nend", "<|endoftext|> don't  stop\r\n\tnow", "a  <|endoftext|>\n\n<|endoftext|><|endoftext|> b.\n", "a.b,\nC!\n\n d'll e's 1.5é.—x"]
    # Two words on which polynomial hashes modulo 2**64 collide, and longer texts of them.
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    texts += [morse, morse.translate({97: 98, 98: 97}), " ".join([morse, "x", "y", "z", "u"]), " ".join([morse.translate({97: 98, 98: 97}), "x", "y", "z", "u"])]
    return texts


def test_quality_rules(spark):
    texts = awkward()
    found = {r.doc_id: r for r in quality_rules.judged(table(spark, texts), ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        counts = collections.Counter(grams)
        covered = {k + d for k, g in enumerate(grams) if counts[g] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        r = found[i]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(words), len(covered), len(lines) - len(set(lines)))
        assert r.word_chars == sum(map(len, words)) and r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_bad_host_is_rejected(spark):
    rows = [(i, "short" if i < 95 else " ".join(BASE), None, "bad", None, None, None) for i in range(100)]
    rows += [(200 + i, " ".join(BASE), None, "good", None, None, None) for i in range(100)]
    found = quality_rules.judged(spark.createDataFrame(rows, SCHEMA), ["doc_id"]).groupBy("source").agg(F.count_if("kept").alias("n")).collect()
    assert {r.source: r.n for r in found} == {"bad": 0, "good": 100}


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def components_by_force(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[j] > label[i]:
                    label[j], changed = label[i], True
    return sets, label


@pytest.mark.parametrize("region_rows, common", [(30_000, 1_000), (30_000, 3), (1, 1_000)])
def test_jaccard_join(spark, region_rows, common):
    texts = awkward()
    for k in range(25):  # a family whose members are linked in part
        words = BASE.copy()
        for p in range(0, 400, 97 + k):
            words[p] = f"v{k}"
        texts.append(" ".join(words))
    sets, label = components_by_force(texts)
    found = {r.doc_id: r for r in jaccard_join.linked(table(spark, texts), region_rows, common).collect()}
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i].component_id for i in range(len(texts))] == label


def test_jaccard_regions_are_exact():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.int64)).view(np.uint64) for _ in range(300)]
    sets += [np.unique(np.concatenate([s[:55], rng.integers(0, 1 << 63, 4, dtype=np.int64).view(np.uint64)])) for s in sets[:150]]
    size = np.array([len(s) for s in sets])
    region = jaccard_join.Region(np.arange(len(sets)), size, np.arange(len(sets)), [jaccard_join.histogram(s) for s in sets])
    found = region.join()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (size[i] + size[j] - both):
                assert (i, j) in found


def test_jaccard_bounds_hold_across_sizes(spark):
    # Borderline pairs whose histograms have different numbers of bins: the smaller set is part of the larger one.
    rng = np.random.default_rng(11)
    sizes = [(112, 140), (224, 280), (448, 560)] * 20
    sets = []
    for small, large in sizes:
        sets.append(np.unique(rng.integers(0, 1 << 63, large + 9, dtype=np.int64).view(np.uint64) * np.uint64(2))[:large])
        sets.append(np.sort(rng.permutation(sets[-1])[:small]))
    size = np.array([len(s) for s in sets])
    found = jaccard_join.Region(np.arange(len(sets)), size, np.arange(len(sets)), [jaccard_join.histogram(s) for s in sets]).join()
    assert {(k, k + 1) for k in range(0, len(sets), 2)} <= found
    texts = []
    for k, (small, large) in enumerate(sizes[:9]):
        words = [f"p{k}q{i}" for i in range(large + 4)]
        texts += [" ".join(words), " ".join(words[: small + 4])]
    found = {r.doc_id: r.component_id for r in jaccard_join.linked(table(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == [i - i % 2 for i in range(len(texts))]


def test_jaccard_join_of_repeated_rows_in_large_regions(spark):
    # Linked pairs that share their later shingles only, each row twice; document 0 has two texts.
    rng = np.random.default_rng(3)
    texts, ids = [], []
    for k in range(12):
        words = [f"r{k}s{i}" for i in range(104)]
        near = words.copy()
        for at in rng.choice(100, 2, replace=False):
            near[at] = "other"
        texts += [" ".join(words), " ".join(near)]
        ids += [2 * k, 2 * k + 1]
    texts, ids = texts * 2 + [texts[5] + " more"], ids * 2 + [0]
    found = {r.doc_id: r.component_id for r in jaccard_join.linked(table(spark, texts, ids), 1).collect()}
    assert found == {i: 0 if i in (4, 5) else i - i % 2 for i in set(ids)}


def test_jaccard_regions_are_bounded(spark):
    # Two groups apart, which pivots split, and copies of one core that differ too little to be split.
    rng = np.random.default_rng(9)
    new = lambda n: rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64) * np.uint64(2)
    cores = [new(60), new(60), new(60)]
    sets = [np.unique(np.concatenate([cores[k % 2], new(8)])) for k in range(60)]
    sets += [np.unique(np.concatenate([cores[2][rng.permutation(60)[:50]], new(4 + k % 20)])) for k in range(60)]
    size = [len(s) for s in sets]
    rows = [(k // 60, k, size[k], k, bytearray(jaccard_join.histogram(s))) for k, s in enumerate(sets)]
    large = spark.createDataFrame(rows, "region long, node long, size long, component long, bins binary")
    members = jaccard_join.bounded(large, 16).cache()
    assert members.groupBy("region").count().agg(F.max("count")).first()[0] <= 24
    found = {(r.a, r.b) for r in jaccard_join.region_pairs(members).collect()}
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if i // 60 == j // 60 and 100 * both >= 80 * (size[i] + size[j] - both):
                assert (i, j) in found


def test_representatives(spark):
    docs = table(spark, ["same text of six words here", "same text of six words here", "b", None, "b", "c"], [3, 1, 5, None, 5, 8])
    found = jaccard_join.representatives(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in found.collect() if r.text) == [(1, "same text of six words here"), (5, "b"), (8, "c")]


@pytest.mark.parametrize("hot", [50_000, 1])
def test_suffix_dedup(spark, monkeypatch, hot):
    texts = awkward() + ["pre " + " ".join(BASE[100:150]) + " post" * 30]
    monkeypatch.setattr(suffix_dedup.with_repeats, "__defaults__", (None, hot, None, None))
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[k : k + 200] for d in data for k in range(len(d) - 199))
    found = {r.doc_id: r for r in suffix_dedup.removal_digests(table(spark, texts)).collect()}
    for i, d in enumerate(data):
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if counts[d[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        rest = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        assert tuple(found[i])[1:] == (len(d), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    cleaned = suffix_dedup.without_repeats(table(spark, texts))
    assert cleaned.count() == len(texts) and cleaned.filter("n_chars != length(text)").isEmpty()


@pytest.mark.parametrize("piece", [512, 3])
def test_cross_parsing_counts_phrases(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    trains = (("a", b"abcab cab " * 9 + b"abcabbacbabcacbcab"), ("b", b"zzyx"))
    parser = language_id.Parser(trains)
    rng = np.random.default_rng(2)
    parts = [b"abcabcab", b"?? zyzz q", b"", bytes(rng.choice(list(b"abcz "), 3000).astype(np.uint8)), b"abcab cab " * 200]
    offsets = np.cumsum([0, *map(len, parts)])
    symbols, offsets = parser.symbols(np.frombuffer(b"".join(parts), np.uint8), offsets)
    found = parser.phrases(symbols, offsets)

    def by_force(text, train):
        n, at = 0, 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in train:
                size += 1
            at, n = at + size, n + 1
        return n

    texts = [bytes(symbols[a:b]) for a, b in zip(offsets, offsets[1:])]
    for k, (_, train) in enumerate(trains):
        learnt = bytes(parser.symbols(np.frombuffer(train, np.uint8), np.array([0, len(train)]))[0])
        assert [int(x) for x in found[:, k]] == [by_force(t, learnt) for t in texts]


def test_language_of_awkward_texts(spark):
    docs = table(spark, awkward())
    found = {r.doc_id: r for r in language_id.with_language(docs, docs).collect()}
    assert [found[i].lang_pred for i in range(3)] == ["und"] * 3 and found[0].score == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.with_language(none, none).collect()} == {"und"}
    lettered = [i for i, t in enumerate(awkward()) if t and re.search(r"[^\W\d_]", t)]
    for known in (docs, none):  # without labels nothing is known, and nothing lost
        kept = language_id.identified(known)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == lettered
    assert language_id.identified(docs).filter("lang is null").isEmpty()


def test_token_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = token_counts.piece_scores(path)

    def by_force(word):
        best = [(0.0, 0)] + [None] * len(word)
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode())
            top = (best[end - 1][0] + token_counts.UNKNOWN, -best[end - 1][1] - size)
            for start in range(end):
                if word[start:end] in scores:
                    top = max(top, (best[start][0] + scores[word[start:end]], -best[start][1] - 1))
            best[end] = (top[0], -top[1])
        return best[-1][1]

    texts = awkward()
    found = {r.doc_id: r for r in token_counts.with_token_counts(table(spark, texts), path).collect()}
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        assert (found[i].n_pretokens, found[i].n_tokens) == (len(words), sum(by_force("▁" + w) for w in words))


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(3)
    grade = rng.integers(0, 3, 600)
    row, bucket = [], []
    for i, g in enumerate(grade):
        for b in [int(rng.integers(10, 60)), *range(g)]:
            row.append(i)
            bucket.append(b)
    row, bucket = np.array(row), np.array(bucket)
    model = toxicity.fit(row, bucket, grade)
    above = model.at_least(row, bucket, len(grade))
    assert (np.diff(model.thresholds) >= 0).all() and (above[:, 0] >= above[:, 1]).all()
    assert ((above >= 0.5).sum(axis=1) == grade).mean() > 0.98


def test_ordinal_fit_minimises_the_penalised_likelihood():
    """Against the likelihood written out over dense rows: steps to the side are hardly better (the fit takes a fixed number of
    steps and ends near the minimum, not at it), and gradients are small for so many rows."""
    rng = np.random.default_rng(8)
    n, width = 120, 5
    dense = rng.integers(0, 2, (n, width))
    grade = np.clip(dense @ np.array([2, 1, 0, -1, 0]) + rng.integers(-1, 2, n), 0, 3)
    row, bucket = np.nonzero(dense)
    model = toxicity.fit(row, bucket + 7, grade, penalty=0.5, rounds=4000)
    used = np.arange(7, 7 + width)

    def cost(weights, thresholds):
        score = dense @ weights
        at_least = [np.ones(n), *(1 / (1 + np.exp(t - score)) for t in thresholds), np.zeros(n)]
        rank = np.searchsorted(np.unique(grade), grade)
        return -sum(np.log(at_least[k][i] - at_least[k + 1][i]) for i, k in enumerate(rank)) + 0.5 * np.abs(weights).sum()

    weights, thresholds = model.weights[used], model.thresholds
    best = cost(weights, thresholds)
    for _ in range(300):
        size = 10.0 ** rng.uniform(-3, 0)
        moved = np.sort(thresholds + size * rng.normal(size=len(thresholds)))
        assert cost(weights + size * rng.normal(size=width), moved) > 0.97 * best
    for k in np.flatnonzero(weights):
        step = np.eye(width)[k] * 1e-5
        assert abs(cost(weights + step, thresholds) - cost(weights - step, thresholds)) / 2e-5 < 0.1 * n
    assert np.count_nonzero(model.weights) == np.count_nonzero(weights) and model.weights[7] > model.weights[8] > 0 > model.weights[10]


def test_toxicity_of_awkward_tables(spark):
    texts = awkward() + ["bad words here", "bad words here", "fine words here"]
    docs = table(spark, texts)
    n = len(texts)
    graded = spark.createDataFrame([(n - 3, 2), (n - 2, 2), (n - 1, 0), (n - 1, 0), (0, None), (None, 1), (0, 0), (4, 0), (5, 1)], "doc_id long, grade int")
    model = toxicity.fitted(graded, docs)
    found = {r.doc_id: r for r in toxicity.with_severity(docs, model).collect()}
    assert len(found) == n and found[n - 3].severity == found[n - 2].severity > found[n - 1].severity
    assert all(0 <= r.severity <= 2 and r.size == 7 and r.toxic == (r.grade > 0) for r in found.values())
    assert found[0].severity == found[1].severity == found[2].severity  # null, empty and blank texts have no features
    assert toxicity.with_severity(spark.createDataFrame([], SCHEMA), model).count() == 0
    same = toxicity.fitted(graded.filter("grade = 2"), docs)  # one grade only
    assert {r.severity for r in toxicity.with_severity(docs, same).collect()} == {2.0}


def test_toxicity_without_labels(spark):
    docs = table(spark, awkward())
    model = toxicity.fitted(spark.createDataFrame([], "doc_id long, grade int"), docs)
    assert docs.count() == toxicity.with_severity(docs, model).filter("not toxic").count()


PAGE = "<html><body><nav><a href='/x'>Home</a></nav><div class='{c}'><h1>{t}</h1><p>{t} one &amp; <b>two</b>three<br>{t}<p>five {t}</div><div id='comments'><p>me too</p></div><footer>f</footer></body></html>"


def test_html(spark):
    rows = [(k, f"http://h{k % 2}.example.org/{k}", PAGE.format(c="post", t=f"T{k}")) for k in range(12)]
    rows += [(100, None, "plain &lt; text"), (101, "no host", None), (102, "http://h0.example.org/z", ""), (103, "http://h0.example.org/y", "<article>x <script>bad()</script>y</article> z"), (0, rows[0][1], rows[0][2])]
    found = html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert all(text[k] == f"T{k} T{k} one & twothree T{k} five T{k}" for k in range(12))
    assert (text[100], text[101], text[102], text[103]) == ("plain < text", "", "", "x y")


def accepts(items, nodes):
    """Whether a wrapper's items match a list of blocks and elements, by trying everything."""
    H = html_extract
    leaf = lambda x: isinstance(x, str) or any(map(leaf, x.items))
    nodes = [x for x in nodes if leaf(x)]

    def ends(x, at):
        """Where one occurrence of an item may end."""
        if x[H.KIND] in (H.GROUP, H.ANY):
            every = set()
            if x[H.KIND] == H.GROUP:
                return after(x[H.INSIDE], {at})
            for y in x[H.INSIDE]:
                every |= ends(y, at)
            return every
        if at == len(nodes) or isinstance(nodes[at], str) != (x[H.KIND] == H.TEXT):
            return set()
        if x[H.KIND] == H.TEXT:
            return {at + 1} if x[H.NAME] in (None, H.digest(nodes[at])) else set()
        return {at + 1} if nodes[at].label == x[H.NAME] and accepts(x[H.INSIDE], nodes[at].items) else set()

    def after(items, starts):
        for x in items:
            found = {z for at in starts for z in ends(x, at)}
            more = found if x[H.REPEATED] else set()
            while more:
                more = {z for at in more for z in ends(x, at)} - found
                found |= more
            starts = found | (starts if x[H.OPTIONAL] or x[H.KIND] == H.ANY else set())
        return starts

    return len(nodes) in after(items, {0})


TAGS = st.recursive(st.sampled_from(["<p>a</p>", "<p>b</p>", "<h1>c</h1>", "d<br>", "<ul><li>e</li><li>f</li></ul>"]), lambda x: st.lists(x, max_size=5).map(lambda y: "<div>" + "".join(y) + "</div>"), max_leaves=8)


@pytest.mark.parametrize("wide", [48, 3])
def test_wrappers_match_their_pages(monkeypatch, wide):
    monkeypatch.setattr(html_extract, "WIDE", wide)

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.lists(TAGS, max_size=6).map("".join), min_size=1, max_size=4))
    def check(pages):
        found = html_extract._grouped(map(html_extract.wrapper_of, pages))
        assert found[html_extract.PAGES] == len(pages)
        assert all(accepts(found[html_extract.INSIDE], html_extract.parsed(page).items) for page in pages)

    check()


def test_wrapper_has_slots_groups_and_repeats():
    H = html_extract
    pages = ["<ul><li>a</li><li>b</li></ul><p>same</p><p>x1</p>", "<ul><li>a</li><li>c</li><li>d</li></ul><h2>same</h2><hr><p>x2</p>"]
    found = H._grouped(map(H.wrapper_of, pages))[H.INSIDE]
    assert [(x[H.NAME], x[H.OPTIONAL], x[H.REPEATED]) for x in found] == [("ul", 0, 0), ("h2", 1, 0), ("p", 0, 1)]
    item = found[0][H.INSIDE][0]
    assert (item[H.NAME], item[H.REPEATED], item[H.INSIDE][0][H.NAME]) == ("li", 1, None)
    assert [x[H.NAME] for x in H.wrapper_of("<dl><dt>a<dd>b<dt>c<dd>d</dl>")[H.INSIDE][0][H.INSIDE][0][H.INSIDE]] == ["dt", "dd"]


def test_wrappers_choose_the_content(spark):
    # No article or main; two templates, one of them with teasers before the text; a line that every page has.
    one = "<body><div class=top><div>Top {k} words</div></div><div class=story{k}><h1>Title {k}</h1><div class=body><p>Own line.</p><p>" + "Text {k} of one. " * 9 + "</p><ul><li>i{k}</li></ul></div></div><div class=x>Links {k}</div></body>"
    two = "<body><div class=list><div class=teaser>Teaser {k}</div><div class=teaser>Other {k}</div></div><section id=text{k}><p>" + "Text {k} of two, which is longer than the rest. " * 9 + "</p></section></body>"
    rows = [(k, f"http://t.example.org/{k}", (two if k % 3 else one).format(k=k)) for k in range(30)]
    rows += [(100, "http://t.example.org/odd", "<body><p>Another shape</p></body>"), (101, None, one.format(k=7))]
    for fan in (64, 2):
        found = html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), fan)
        text = {r.page_id: r.text for r in found.collect()}
        for k in range(30):
            want = " ".join(["Text", str(k), "of two, which is longer than the rest."] * 9) if k % 3 else f"Title {k} Own line. " + " ".join([f"Text {k} of one."] * 9) + f" i{k}"
            assert text[k] == want
        assert text[100] == "Another shape" and "Title 7 Own line." in text[101]
    # Without the wrapper of its host the page with teasers keeps them.
    assert "Teaser" in html_extract.main_text(two.format(k=1), {"content": [], "own": []})


def test_texts_of_the_host_go_from_the_content():
    H = html_extract
    page = "<article><h1>T{k}</h1><p>" + "Words {k} here. " * 20 + "</p><div class=terms>Read our terms.</div></article>"
    pages = [page.format(k=k) for k in range(4)]
    host = H.summary(H._grouped(map(H.wrapper_of, pages)))
    assert host["own"] and H.main_text(pages[2], host) == "T2 " + " ".join(["Words 2 here."] * 20)
    same = H.summary(H._grouped(map(H.wrapper_of, pages[:1] * 4)))  # pages that are all alike keep their text
    assert H.main_text(pages[0], same).endswith("Read our terms.")


def test_malformed_and_long_pages():
    text = lambda page: html_extract.main_text(page, None)
    assert text("<article><p title=\"x>text</p><p>b</p></article>") == "text b"
    assert text("<p>a < b &amp; c > d</p><p") == "a < b & c > d"
    assert text("<p>one<b>two</p><p>three</b></div></p>") == "onetwo three"
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after") == "deep after"
    long = "<article>" + "".join(f"<p>{k}</p><ul><li>{k}</li></ul>" * (1 + k % 3) for k in range(3000)) + "</article>"
    assert text(long).split() == [str(k) for k in range(3000) for _ in range(2 * (1 + k % 3))]


def test_pages_with_extra_columns_and_repeated_rows(spark):
    rows = [(1, "http://h.example.org", "<p>x</p>", "own", 5, "w")] * 2 + [(None, None, None, None, None, None)]
    found = html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, summary string"))
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found.collect()) == [(0, "", 0), (1, "x", 1), (1, "x", 1)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_256), st.integers(0, (1 << 64) - 1)), max_size=700))
def test_simple8b_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, lanes = token_output.pack(ids)
    assert (token_output.unpack(words, lanes, len(ids)) == ids).all()


def test_token_ids_files(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = awkward()
    ids = [5 * i + 1 for i in range(len(texts))]
    found = token_output.token_ids(table(spark, texts, ids), path).orderBy("doc_id").collect()
    before = 0
    for r, text in zip(found, texts):
        want = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(want), zlib.crc32(want.tobytes()))
        before += len(want)


def test_decontamination(spark):
    items = [(1, " ".join(BASE[10:40])), (2, "Short Item"), (3, None), (4, ""), (None, " ".join(BASE[300:314])), (2, "Short Item")]
    texts = awkward() + ["x short-item y", " ".join(["pad"] * 300 + BASE[10:24])]
    found = {}
    for size in (500_000, 16):  # one block of items, and several, in pieces of 16 words
        rows = decontaminate.with_contamination(table(spark, texts), spark.createDataFrame(items, "item_id long, text string"), 13, None, size).collect()
        found[size] = {r.doc_id: r for r in rows}
    for i, text in enumerate(texts):
        words = decontaminate.words(text)
        hit, owners = set(), set()
        for item, item_text in items:
            w = decontaminate.words(item_text)
            size = min(13, len(w))
            for a in range(len(w) - size + 1 if size else 0):
                for b in range(len(words) - size + 1):
                    if words[b : b + size] == w[a : a + size]:
                        hit |= set(range(b, b + size))
                        owners |= {str(item)} if item is not None else set()
        for r in (found[500_000][i], found[16][i]):
            assert (r.n_words, r.n_hit, r.n_items) == (len(words), len(hit), len(owners))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
            assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
    clean = decontaminate.decontaminated(table(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == table(spark, texts).columns


def test_bpe_codec(spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(path), special_tokens={})
    texts = awkward()
    found = {r.doc_id: r for r in bpe_codec.encoded_digests(table(spark, texts), path).collect()}
    for i, text in enumerate(texts):
        want = np.array(library.encode_ordinary(text or ""), "<u4")
        assert (found[i].n_tokens, found[i].ids_sha256) == (len(want), hashlib.sha256(want.tobytes()).hexdigest())
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert {r.doc_id: r.text for r in bpe_codec.round_tripped(table(spark, texts), path).collect()} == dict(enumerate(texts))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'\n\t   é中1.,!\x1c")), max_size=40))
def test_stretches_do_not_change_pretokens(text):
    from evigraph.llm.pretokens import CachedEncoder

    seen = []
    encoder = CachedEncoder(public_tokenizers.PATTERN, lambda pieces: [seen.append(p) or [len(p)] for p in pieces])
    numbers, counts = encoder.encode(pa.array([text]))
    assert numbers.tolist() == [len(p) for p in encoder.find(text)] and counts.tolist() == [len(numbers)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert quality_rules.judged(empty, ["doc_id"]).count() == 0
    assert jaccard_join.linked(empty).count() == 0
    assert suffix_dedup.removal_digests(empty).count() == 0
    assert language_id.with_language(empty, empty).count() == 0
    assert token_counts.with_token_counts(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert toxicity.with_severity(empty, toxicity.fitted(spark.createDataFrame([], "doc_id long, grade int"), empty)).count() == 0
    assert html_extract.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert token_output.token_ids(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert decontaminate.with_contamination(empty, items).count() == 0
    assert bpe_codec.encoded_digests(empty, path).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Every stage by brute force on what the one before kept."""
    import corpus_pipeline
    import tiktoken

    texts = awkward() + [" ".join(f"u{k}v{k * j % 31}" for k in range(60)) for j in range(3)]
    texts += ["kept words before " + " ".join(BASE[100:150]) + " and after"]
    folder = str(tmp_path)
    table(spark, texts).drop("severity", "size").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, texts[-2])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}

    lettered = [i for i, t in enumerate(texts) if t and re.search(r"[^\W\d_]", t)]
    _, label = components_by_force([texts[i] for i in lettered])
    kept = [i for k, i in enumerate(lettered) if label[k] == k]
    data = [texts[i].encode() for i in kept]
    counts = collections.Counter(d[k : k + 200] for d in data for k in range(len(d) - 199))
    cleaned = {}
    for i, d in zip(kept, data):
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if counts[d[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        cleaned[i] = bytes(b for b, g in zip(d, gone) if not g).decode("utf-8", "ignore")
    item = decontaminate.words(texts[-2])
    windows = {tuple(item[k : k + 13]) for k in range(len(item) - 12)}

    def clean(text):
        words = decontaminate.words(text)
        hit = {k + d for k in range(len(words) - 12) if tuple(words[k : k + 13]) in windows for d in range(13)}
        return not hit or 20 * len(hit) < len(words)

    want = {i: t for i, t in cleaned.items() if clean(t)}
    assert len(texts) - 2 not in want and cleaned[len(texts) - 1] != texts[-1]
    assert {i: r.text for i, r in found.items()} == want
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(path), special_tokens={})
    for i, r in found.items():
        assert r.token_ids == library.encode_ordinary(want[i]) and r.n_tokens == len(r.token_ids) and r.n_chars == len(want[i]) and r.lang == "en"


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    table(spark, []).drop("severity", "size").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0

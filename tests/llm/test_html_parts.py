"""Containers that are named after what is in them, pages under other partitionings, and accuracy on the given pages."""

from __future__ import annotations

import html as entities
import random
import re

import pytest

from evigraph.llm import html_extract, queries

from ..conftest import SF

WORDS = "Some words of the main text that is long enough to be the article of the page. "
MENU = '<nav><a href="/">Home</a></nav>'
SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "page with-sidebar", "content-header", "ad", "social", "related", "share-page", "notice", "modal-open"])
@pytest.mark.parametrize("kind", ["class", "id"])
def test_containers_of_an_article_stay(name, kind):
    page = f'<body>{MENU}<div {kind}="{name}"><article><h1>Title</h1><p>{WORDS}</p><div class="share">Share</div></article><div class="sidebar">Side</div></div><footer>End</footer></body>'
    assert html_extract.main_text(page, None) == f"Title {WORDS.strip()}"


@pytest.mark.parametrize("name", ["has-sidebar", "page with-sidebar", "share-page", "modal-open"])
def test_containers_without_an_article_stay(name):
    page = f'<body>{MENU}<div class="{name}"><div class="text"><p>{WORDS * 3}</p></div><div class="sidebar">Side</div></div><footer>End</footer></body>'
    assert html_extract.main_text(page, None) == (WORDS * 3).strip()


@pytest.mark.parametrize("part", ['<div class="sidebar"><article>Teaser</article></div>', '<div class="comments"><p>{}</p></div>', '<div class="cookie-banner">{}</div>', '<div class="ad">Buy</div>', '<ul id="related"><li>More</li></ul>'])
def test_parts_beside_and_within_an_article_go(part):
    part = part.format(WORDS * 9)
    for page in (f"<body><article><p>{WORDS}</p></article>{part}</body>", f"<body><article><p>{WORDS}</p>{part}</article></body>"):
        assert html_extract.main_text(page, None) == WORDS.strip()


def test_header_of_an_article_stays():
    page = f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{WORDS}</p></article></body>"
    assert html_extract.main_text(page, None) == f"Title {WORDS.strip()}"


def mixed_pages(seed):
    draw = random.Random(seed)
    pages = []
    for k in range(40):
        blocks = [f"<p>{draw.choice(['Own text of the host.', f'Text {k} of {draw.random()}. ' * draw.randint(1, 9)])}</p>" for _ in range(draw.randint(1, 6))]
        if draw.random() < 0.3:
            blocks.insert(draw.randint(0, len(blocks)), f"<ul>{''.join(f'<li>{draw.random()}</li>' for _ in range(draw.randint(1, 5)))}</ul>")
        shell = draw.choice(['<div class="main"><div class="text">{}</div></div><div class="more">Always here.</div>', '<table><tr><td>{}</td></tr></table><div class="more">Always here.</div>', '<div class="main">{}</div>'])
        pages.append((k, f"https://h{k % 4}.example.org/{k}", f"<html><body>{shell.format(''.join(blocks))}</body></html>"))
    return pages


@pytest.mark.parametrize("seed", range(3))
def test_texts_do_not_depend_on_partitions(spark, seed):
    pages = mixed_pages(seed)
    found = []
    for partitions in (1, 7):
        random.Random(partitions).shuffle(pages)
        df = spark.createDataFrame(pages, SCHEMA).repartition(partitions)
        found.append({r.page_id: r.text for r in html_extract.extracted(df, fan=3).collect()})
    assert found[0] == found[1] and len(found[0]) == len(pages)


def test_accuracy_on_the_given_pages(spark):
    """The words of each page's article, by a plain reading of its marks."""
    articles = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)
        articles[r.page_id] = entities.unescape(re.sub(r"<(?:p|h1|br)[^>]*>", " ", re.sub(r"</?(?:b|i|a)\b[^>]*>", "", body[1]))) if body else ""
        articles[r.page_id] = " ".join(re.sub(r"<[^>]*>|<!--.*?-->", " ", articles[r.page_id]).split())
    found = {r.page_id: r.text for r in queries.op7_html_extraction(spark, SF).collect()}
    assert set(found) == set(articles)
    assert sum(found[k] == articles[k] for k in found) == len(found)

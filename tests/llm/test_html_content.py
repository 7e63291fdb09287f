import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from abacist.llm import html_content, html_parts
from abacist.llm.common import in_share
from abacist.llm.html_tree import FEATURES, Page


@pytest.fixture(scope="module")
def model():
    return html_content.train(html_parts.built_pages())


def test_held_out_built_pages(model):
    wrong = total = 0
    for seed in range(5000, 5150):
        page = Page(html_parts._Writer(seed).page())
        labels = html_content._labels(page, None)
        content, _ = html_content.Forest([page]).marginals(model.weights, model.edges)
        for i, text in enumerate(page.text):
            if text and text.strip():
                total += 1
                wrong += (content[i] > 0.5) != labels[i]
    assert wrong < 0.02 * total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    page = Page("<div class=ad><p>a, b<b>c</b></div><nav><a href=x>d</a></nav>e")
    forest = html_content.Forest([page])
    weights, edges = rng.normal(size=len(FEATURES)), rng.normal(size=(4, 2, 2))
    own = forest.scores(weights)
    chance = np.zeros(forest.n)
    total = 0.0
    for labels in itertools.product((0, 1), repeat=forest.n):
        energy = sum(own[i] for i in range(forest.n) if labels[i])
        energy += sum(edges[forest.kind[i], labels[forest.parent[i]], labels[i]] for i in range(1, forest.n))
        total += np.exp(energy)
        chance += np.exp(energy) * np.array(labels)
    content, pairs = forest.marginals(weights, edges)
    assert content == pytest.approx(chance / total)
    assert pairs[1:, :, 1].sum(axis=1) == pytest.approx(content[1:])


TEXT = "Some words of the story, which is told here. It goes on and on, for a while."


@pytest.mark.parametrize(
    "html,want",
    [
        (f"<html><body><nav><a href=1>Home</a></nav><article><p>{TEXT}</p><p>{TEXT}</p></article><footer>&copy; us</footer>", f"{TEXT} {TEXT}"),
        (f"<article><p>{TEXT}<br>x &amp; y\n\t z&nbsp;&eacute;</p><script>var a='</p>';</script><!-- no --></article>", f"{TEXT} x & y z é"),
        (f"<div class='cookie-notice'>We use cookies</div><article><p>{TEXT}<b>bold</b>er</p></article>", f"{TEXT}bolder"),
        ("", ""),
        ("<", None),
        ("<p", None),
        ("</div></p><nav><li><a href=x>a</a>", None),
    ],
)
def test_extraction(model, html, want):
    (text,) = model.extract([html])
    assert want is None or text == want


def test_deep_and_long_pages(model):
    deep = "<div>" * 3000 + f"<p>{TEXT}</p>"
    long = "<article>" + f"<p>{TEXT}</p>" * 5000 + "</article>"
    texts = model.extract([deep, long])
    assert texts[1] == " ".join([TEXT] * 5000)


def test_rows(spark):
    rows = [(1, "u", f"<article><p>{TEXT}</p></article>"), (2, None, None), (2, None, None), (None, "v", ""), (3, "w", TEXT)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = html_content.main_texts(df).collect()
    assert sorted((str(r.page_id), r.url, r.n_chars) for r in found)[:2] == [("1", "u", len(TEXT)), ("2", None, 0)]
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    assert html_content.main_texts(df.where("false")).collect() == []


def test_linked_pages_are_found(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/en/7?x=1", "h1"), (2, "http://a/8.html", "h2"), (3, "http://a/9x", "h3"), (4, None, "h4")],
        "page_id long, url string, html string",
    )
    docs = spark.createDataFrame([(7, "seven"), (8, ""), (8, "eight"), (9, "nine")], "doc_id long, text string")
    found = html_content.linked_pages(pages, docs).collect()
    assert sorted(map(tuple, found)) == [("h1", "seven"), ("h2", "eight")]


@pytest.mark.parametrize(
    "html,want",
    [
        (f"<!doctype html><head><title>T</title><meta charset=utf-8><p>{TEXT}", TEXT),
        (f"<head><title>T</title>{TEXT}", TEXT),
        (f"<head><title>T</title></head><article><p>{TEXT}</p><head><p>{TEXT}</p></article>", f"{TEXT} {TEXT}"),
        (f"<p>{TEXT} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> so.</p>", f"{TEXT} x=1 so."),
        ("<p>a</p><xmp><b>&amp;</xmp><p>c</p>", "a <b>&amp; c"),
        (f"<div><select><option>a</div><p>{TEXT}</p>", TEXT),
        (f"<div><svg><path></div><p>{TEXT}</p>", TEXT),
        (f"<svg><path><p>{TEXT}</p>", TEXT),
        (f"<svg><g></g></svg><template><div>x</div></template><p>{TEXT}</p>", TEXT),
        (f"<p>{'\u0130' * 30}</p><script>var a;</SCRIPT><p>{TEXT}</p>", f"{'\u0130' * 30} {TEXT}"),
    ],
)
def test_no_text_is_lost_to_the_parser(html, want):
    page = Page(html)
    assert page.main_text(np.ones(len(page.parent))) == want


def test_stray_closing_tags_cost_no_search():
    """Time in proportion to the page, and the tree that it has without them."""
    page = "<div>" * 20_000 + TEXT + "</x></span>" * 20_000 + "</div>" * 20_000
    start = time.process_time()
    found = Page(page)
    assert time.process_time() - start < 8
    plain = Page("<div>" * 20_000 + TEXT + "</div>" * 20_000)
    assert (found.parent, found.tag) == (plain.parent, plain.tag)


@pytest.mark.parametrize("total", [0, 10, 1000, 10**9, 10**15])
def test_some_pages_are_chosen_however_many_there_are(spark, total):
    n = spark.range(100_000).where(in_share(F.xxhash64("id"), 200, total)).count()
    assert abs(n - 100_000 * min(200 / max(total, 1), 1)) <= 1000 and (n > 0 or total > 10**6)
    assert (200 << 62) // max(total, 1) > 0

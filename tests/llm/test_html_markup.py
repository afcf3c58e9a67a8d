"""Operator 9 on malformed markup, class names, references; template counts against a plain recount."""
import random
import time
from collections import defaultdict
from math import ceil

import pytest
from llm_cases import SMALL, frame, have_data  # noqa: F401

from qualis.llm import html_template as H


def text(source):
    return H.Page("h").walk(source).main_text()


@pytest.mark.parametrize("unit", ["<a", "<a ", '<a "', "<a '", "<!--", "<!---->", "<!-- x --!>", "</", "<script", "<title>", '<p class="',
                                  "<a b='x>", "&am", "<?", "<![CDATA["])
def test_a_megabyte_of_broken_markup_is_fast(unit):
    source = unit * (1_000_000 // len(unit))
    began = time.process_time()
    H.Page("h").walk(source).main_text()
    H.Page("h").walk(source + ">").main_text()
    assert time.process_time() - began < 4  # two pages


@pytest.mark.parametrize("unit", ["<div>", "<li><span>", "<td><table><span>", "<table><td><b>", "<p><i>"])
def test_deep_nesting_is_linear_and_keeps_its_text(unit):
    source = unit * 20_000 + "end"
    began = time.process_time()
    assert text(source) == "end"
    assert time.process_time() - began < 4


@pytest.mark.parametrize("source,want", [
    ("<p>a<b>&am</b>p; b</p>", "a&amp; b"),  # no reference across two text nodes
    ("<p>&lt;b&gt; &amp;amp; &#233;&eacute;&nbsp;x</p>", "<b> &amp; éé x"),
    ("a < b <p>c</p> 1<2", "a < b\n\nc\n\n1<2"),
    ("<a href='x>y'>k</a>", "k"),
    ('<a href="x>y <p>k</p>', "y\n\nk"),
    ("<p>x<!-- no end", "x"),
    ("<p>x<!-- a --!>y<!-->z", "xy"),
    ("<p>x</p", "x</p"),
    ("<div class='market-share'>x</div><div class='related-work'>y</div>", "x\n\ny"),
    ("<div class='site-footer'>x</div><div class='ad_slot_2'>x</div><div class='related-posts'>x</div>y", "y"),
    ("<article class='post-header'>x</article>", "x"),
])
def test_markup(source, want):
    assert text(source) == want


def test_keys_equal_a_plain_recount(spark, frame, have_data):
    rng = random.Random(6)
    shared = [f"<div class=c{k}><p>block {k} of all pages</p></div>" for k in range(12)]
    pages = []
    for n in range(160):
        host = f"h{n % 3 if n % 5 else 9}.org"
        own = f"<div><p>{' '.join(str(rng.random()) for _ in range(rng.randint(1, 40)))}</p></div>"
        parts = [own, *rng.sample(shared, rng.randint(0, 5))]
        rng.shuffle(parts)
        pages += [(n, f"http://{host}/{n}", "".join(parts))] * rng.choice([1, 1, 3])
    pages += [(n, r.url, r.html) for n, r in enumerate(spark.read.parquet(f"{SMALL}/pages.parquet").limit(80).collect(), 1000)]
    bodies, sizes, large = defaultdict(set), defaultdict(set), set()
    for _, url, source in pages:
        page = H.Page(H.host_of(url)).walk(source)
        sizes[page.host].add(page.body())
        for key, size in page.keys.items():
            bodies[page.host, key].add(page.body())
            if 2 * size > page.total:
                large.add((page.host, key))
    want = {}
    for (host, key), held in bodies.items():
        n, all_ = len(held), len(sizes[host])
        least = max(2, min(H.MIN_PAGES, ceil(all_ * H.SMALL_SHARE)), ceil(all_ * H.MIN_SHARE))
        if n > 1 and (n >= least or (host, key) in large):
            want[key] = (n, n - least, n >= all_ * H.MOST)
    docs = frame(pages, "page_id long, url string, html string").repartition(5)
    got = {r["key"]: (r["n"], r["spare"], r["most"]) for r in H.template_keys(docs.select("url", "html")).collect()}
    assert got == want and len(want) > 20

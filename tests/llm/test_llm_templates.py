import html
import random
import re
import time

import pytest

from roamsight.llm import templates
from roamsight.llm.common import table
from roamsight.llm.queries import op2_template_classes

SHAPE = "page_id bigint, url string, html string"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><div id=sidebar><p>no</div><main><header><h1>T</h1></header><p class='lead'>a <b>b</b>c<p>d&amp;e</main>", "T a bc d&e"),
        ("<main><p>x<div class='user-comments'><p>no</div><form><p>no</form><aside>no</aside><p>y</main><footer>f</footer>", "x y"),
        ("plain  text &lt; more\n", "plain text < more"),
        ("<p>x<!-- unclosed <p>y", "x"),
        ("<p>a<script>if (a < b) '</p>'</script>b<style>p{}</style></p>", "a b"),
        ("<p title='a > b'>x<br>y</p><img alt='no'>", "x y"),
        ("<div class='cookie-notice'>no</div><div hidden>no</div><div class='content'>one<table><tr><td>c1<td>c2</table></div>", "one c1 c2"),
        ("<article>a</article><p>teaser</p>", "a"),
        ("<nav>only a menu", ""),
        ("<script>never closed", ""),
        ("a < b &amp; c", "a < b & c"),
        ("<p>a <span class='ad'>no <span>no</span> no</span>b <b class=adage>c</b><i hidden>no</p><p>d", "a b c d"),
        ("<p>a <a b=\"c", 'a <a b="c'),
        ("<p>a<!b<p c='>'>d", "a'>d"),
        ("", ""),
    ],
)
def test_pages(page, text):
    assert templates.main_text(page, set()) == text


def test_template_of_a_host(spark):
    """Without marked parts, text that stands in most pages is template, whatever its tags."""
    page = "<html><body><div><span>Site of things</span></div><div><p>{}</p>{}</div><div>{}All rights kept</div></body></html>"
    rows = [(i, f"http://h.org/{i}", page.format(f"story {i} told", f"<p>more {i}</p>" * (i % 3), "<p>Read on</p>" if i % 5 else "")) for i in range(40)]
    rows += [(100 + i, f"http://small.org/{i}", page.format("alone", "", "")) for i in range(templates.FEWEST - 1)]
    texts = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, SHAPE)).collect()}
    for i in range(40):
        assert texts[i] == " ".join([f"story {i} told"] + [f"more {i}"] * (i % 3))
    assert texts[100] == "Site of things alone All rights kept"


def test_classes_nest():
    classes = [
        {"first": 0.0, "last": 1.0, "tokens": [1, 2]},
        {"first": 0.2, "last": 0.6, "tokens": [3, 4]},
        {"first": 0.4, "last": 0.8, "tokens": [5, 6]},  # crosses the one before
        {"first": 0.7, "last": 0.9, "tokens": [7, 8]},
    ]
    assert templates.nest(classes) == [[1, 2], [3, 4], [7, 8]]


def test_dirty_rows(spark, clashing, monkeypatch):
    long = "<article><p>" + "word " * 100_000 + "</article>"
    rows = [(1, None, "<p>a</p>"), (2, "http://x.org/", None), (2, "http://x.org/", None), (None, "no url", ""), (5, "http://x.org/1", long)]
    rows += [(6, "http://x.org/1", "<article>z</article>")] * 8
    pages = clashing(spark.createDataFrame(rows, SHAPE), "host", "TEXT", "page_host", "template_tokens", "salt")
    expected = [(0, ""), (1, "a"), (2, ""), (2, ""), (5, ("word " * 100_000).strip())] + [(6, "z")] * 8
    for limit in (templates.BROADCAST_ROWS, 0):
        monkeypatch.setattr(templates, "BROADCAST_ROWS", limit)
        found = templates.extract(pages).collect()
        assert sorted((r.page_id or 0, r.text) for r in found) == expected
        assert all(r.host == "extra host" and r.salt == "extra salt" for r in found)
    assert templates.extract(pages.limit(0)).collect() == []


def test_registered_query_against_the_marked_article(spark, sf_dir):
    """The given pages mark their article, so a plain expression tells what to expect."""
    rows = {r.page_id: r for r in op2_template_classes(spark, sf_dir).collect()}
    pages = table(spark, sf_dir, "pages").collect()
    assert len(rows) == len(pages)
    for r in pages:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?(?:p|h\d)\b[^>]*>", inside)]
        assert rows[r.page_id].text == " ".join(b for b in blocks if b)
        assert rows[r.page_id].n_chars == len(rows[r.page_id].text) and rows[r.page_id].url == r.url


@pytest.mark.parametrize("piece", ["<a ", '<p title="x ', "<p title='x\" ", "<!", "<!--", "<", "</", "<a b=\">", "&", "<p>", "<b class=ad>", "<x '\""])
def test_long_broken_pages(piece):
    """Two megabytes of what never ends; time has to grow with the text alone."""
    start = time.perf_counter()
    templates.main_text(piece * (2_000_000 // len(piece)), set())
    assert time.perf_counter() - start < 20


def test_scanner_against_a_plain_search():
    rng = random.Random(3)
    plain = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
    for _ in range(3000):
        text = "".join(rng.choice(["<", ">", '"', "'", "a", " ", "/", "!", "-", "<a ", "<!--", "-->", "="]) for _ in range(rng.randrange(25)))
        scanner, at, found = templates.Scanner(text), 0, []
        while (one := scanner.next(at))[0] >= 0:
            found.append(one)
            at = one[1]
        assert found == [(m.start(), m.end(), m[1], m[2] or "") for m in plain.finditer(text)]

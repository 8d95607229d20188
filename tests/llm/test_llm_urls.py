import random
import re

import pytest
from pyspark.sql import functions as F

from roamsight.llm import urls
from roamsight.llm.common import table
from roamsight.llm.queries import op1_url_trees


def parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    lower = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s)
    return (lower(found[1]), found[2]) if found else ("", "")


def fitting(url, rules):
    host, path = parts(url)
    fits = [(r, v) for r, v in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = [
    "http://A.Example.NET/en/1?x=1&y=2#z",
    "https://example.net/en",
    "example.net/en/",
    "http://example.net",
    "http://net/",
    "http://xnet/fr/",
    "http://www.org/fr/a",
    "http://notexample.com/de/",
    "a://b://example.com/de/",
    "http://example.com/de/?u=http://x.org/fr/",
    "http://example.com#/de/",
    "http://example.com?/de/",
    "://",
    "",
    None,
    "http://ex.org/fr/\nline",
]


def test_parts_and_rules(spark):
    frame = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = urls.host(F.col("url")), urls.path(F.col("url"))
    rows = frame.select("url", host.alias("h"), path.alias("p"), urls.rule_of(host, path, urls.RULES).alias("r")).collect()
    for r in rows:
        assert (r.h, r.p) == parts(r.url)
        assert (r.r.rule, r.r.verdict) if r.r else (None, None) == fitting(r.url, urls.RULES)
        assert ((r.r.rule, r.r.verdict) if r.r else (None, None)) == fitting(r.url, urls.RULES)


def test_features(spark):
    frame = spark.createDataFrame([("https://a-1.b.com/x/22?p=1&q=2",), ("",), ("aab",)], "url string")
    rows = frame.select("url", *[c.alias(n) for n, c in urls.lexical(F.col("url"), urls.host(F.col("url")), urls.path(F.col("url"))).items()]).collect()
    first = rows[0].asDict()
    expected = {"url_length": 30, "host_length": 9, "host_depth": 2, "path_depth": 2, "parameters": 2, "hyphens": 1, "host_digits": 1, "secure": 1}
    assert {k: first[k] for k in expected} == expected and first["digit_ratio"] == pytest.approx(5 / 30)
    assert rows[1].entropy == 0 and rows[2].entropy == pytest.approx(0.9182958)


@pytest.fixture(scope="module")
def labelled():
    source = random.Random(3)
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        word = "".join(source.choices("0123456789" if bad else "abcdefgh", k=12))
        query = "&".join(f"p{j}={source.randint(0, 9)}" for j in range(source.randint(3, 6))) if bad else ""
        rows.append((i, f"http://{'listed-' + ('bad' if bad else 'good') + '.net' if i < 400 else 'other.info'}/{word}/{i}{'?' + query if query else ''}"))
    return rows


def test_trees_learn_from_labelled_urls(spark, labelled):
    rules = [("listed-bad.net/", "block"), ("listed-good.net/", "allow")]
    rows = urls.judge(spark.createDataFrame(labelled, "page_id int, url string"), rules).collect()
    held_out = [r for r in rows if r.page_id >= 400]
    right = [(r.verdict == "block") == (r.page_id % 3 == 0) for r in held_out]
    assert len(right) == 200 and sum(right) >= 0.95 * 200
    assert all(r.rule is None for r in held_out)


def test_dirty_rows(spark, clashing):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS)] + [(None, "http://q.com/" + "x/" * 20_000)], "page_id int, url string")
    pages = clashing(pages, "HOST", "label", "found", "url_key", "judged_url", "page", "p")
    rows = urls.judge(pages).collect()
    assert len(rows) == 2 * len(URLS) + 1
    for r in rows:
        assert (r.host, r.path) == parts(r.url) and r.label == "extra label" and r.page == "extra page"
        rule, verdict = fitting(r.url, urls.RULES)
        assert r.rule == rule and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urls.judge(pages.limit(0)).collect() == []


def test_one_class_and_no_class(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.com/"), (3, None)], "page_id int, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages).collect()} == {1: "block", 2: "block", 3: "block"}
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}


def test_registered_query(spark, sf_dir):
    pages = {r.page_id: r.url for r in table(spark, sf_dir, "pages").collect()}
    rows = op1_url_trees(spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        rule, verdict = fitting(pages[r.page_id], urls.RULES)
        assert (r.host, r.path, r.rule) == (*parts(pages[r.page_id]), rule)
        assert r.verdict == (verdict or ("block" if r.block_probability >= 0.5 else "allow"))

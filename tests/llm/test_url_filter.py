import math
import re

import pytest

from abacist.llm import url_filter
from abacist.llm.url_filter import Rule

RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
URLS = [
    "http://a.example.net/en/1", "http://a.example.net/EN/1", "http://example.net/en/", "http://example.net/en", "http://xexample.net/en/1",
    "http://A.EXAMPLE.COM/de/5?x=/fr/", "https://b.org/fr/1#x", "https://b.org?/fr/", "ftp://net/", "http://net", "net/", "", None,
    "http://", "://x.org/fr/", "http://x://y.net/", "a\nhttp://ÄB.org/fr/\nz?q", "http://h.com:80/de/", "http://example.com/de/",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")


@pytest.fixture(scope="module")
def many():
    good = [f"https://site{i % 9}.example.com/en/{i}" for i in range(150)]
    bad = [f"http://x{i * 7919 % 10007}-{i}.info/{i * 104729}/a/b/c/d?id={i}&s={i * 31}&t=1" for i in range(150)]
    return good, bad


def test_parts_and_rules(spark):
    df = frame(spark, URLS)
    found = url_filter.judge(df, url_filter.rule_labels(df, RULES), RULES).collect()
    assert len(found) == len(URLS)
    for r in found:
        host, path, rule = brute(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), r
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")


def test_trees_learn_the_labels(spark, many):
    good, bad = many
    labelled = [(u, 0) for u in good[:100]] + [(u, 1) for u in bad[:100]] + [(None, 1), (good[0], None)]
    labelled = spark.createDataFrame(labelled, "url string, label int")
    df = frame(spark, [*good[100:], *bad[100:], None])
    found = {r.page_id: r.verdict for r in url_filter.judge(df, labelled, []).collect()}
    assert [found[i] for i in range(100)] == ["allow"] * 50 + ["block"] * 50
    assert found[100] in ("allow", "block")


def test_features(spark):
    url, host, path = "https://a1.b.org/x/y2?p=1&q=2#t", "a1.b.org", "/x/y2"
    df = spark.createDataFrame([(url, host, path)], "url string, host string, path string")
    got = df.select(*[c.alias(n) for n, c in url_filter.lexical(*(df[c] for c in df.columns)).items()]).first()
    from math import log2

    want = -sum(url.count(c) / len(url) * log2(url.count(c) / len(url)) for c in set(url))
    assert got.f_entropy == pytest.approx(want)
    assert (got.f_length, got.f_depth, got.f_labels, got.f_parameters, got.f_secure) == (len(url), 2, 2, 3, 1)
    assert got.f_digits == pytest.approx(4 / len(url))


def test_no_labels_one_label_no_rows(spark):
    df = frame(spark, URLS)
    none = spark.createDataFrame([], "url string, label int")
    assert {r.verdict for r in url_filter.judge(df, none, []).collect()} == {"allow"}
    only = spark.createDataFrame([("http://a.b/", 1)], "url string, label int")
    assert {r.verdict for r in url_filter.judge(df, only, []).collect()} == {"block"}
    assert url_filter.judge(df.where("false"), none, RULES).collect() == []


def test_no_python_in_the_plan(spark, many):
    good, bad = many
    labelled = spark.createDataFrame([(u, 0) for u in good] + [(u, 1) for u in bad], "url string, label int")
    plan = url_filter.judge(frame(spark, URLS), labelled, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_records_cover_all_labelled_addresses(spark, many, monkeypatch):
    good, bad = many
    seen = []
    add = url_filter._with_records
    monkeypatch.setattr(url_filter, "_with_records", lambda rows, records: seen.append(records) or add(rows, records))
    labelled = spark.createDataFrame([(u, 0) for u in good] + [(u, 1) for u in bad], "url string, label int")
    url_filter.judge(frame(spark, URLS), labelled, [], most=60)
    found = {r.s1: (r.f_s1_rate, r.f_s1_known) for r in seen[0]["s1"].collect()}
    assert found["com"] == pytest.approx((1 / 152, math.log1p(150)))
    assert found["info"] == pytest.approx((151 / 152, math.log1p(150)))
    assert seen[0]["s2"].count() == len({u.split("/")[2] for u in bad}) + 1

import re

import pytest
from pyspark.sql import functions as F

from larkspur.llm import url_reputation as ur
from larkspur.llm.queries import QUERIES, SQL, URL_RULES
from tests.compare import compare, duck


def brute(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


URLS = [
    "http://WWW.Example.com/en/x?q#f", "https://a.b.net/es/1", "x", None, "", "://", "http://", "ftp://HÔST/p://q", "http://com", "http://com/",
    "http://example.com/en", "http://notexample.com/en/", "http://example.com?x=/en/", "http://u@h.co.uk:80/p", "http://10.0.0.1/x", "a\nb://c\nd/e\nf?",
    "http://" + "a" * 50_000 + "/p", "http://x.net/fr/#a", "http://net/es/",
]


def test_host_path_and_rule(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "i int, url string")
    host, path = ur.url_host(F.col("url")), ur.url_path(F.col("url"))
    for r in df.select("url", host.alias("h"), path.alias("p"), ur.best_rule(host, path, URL_RULES).alias("rule")).collect():
        h, p = brute(r["url"])
        assert (r["h"], r["p"]) == (h, p)
        fits = [x for x in URL_RULES if (h == x.host or h.endswith("." + x.host)) and p.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r["rule"] and tuple(r["rule"])) == (best and (best.text, best.verdict))


@pytest.mark.parametrize("host, domain, suffix", [
    ("a.b.example.com", "example.com", "com"), ("example.co.uk", "example.co.uk", "co.uk"), ("x.example.co.uk", "example.co.uk", "co.uk"),
    ("localhost", "localhost", "localhost"), ("10.0.0.1:80", "10.0.0.1", "10.0.0.1"), ("u@a.org.:443", "a.org", "org"), ("", "", ""),
])
def test_levels(spark, host, domain, suffix):
    d = ur.registered_domain(F.lit(host))
    assert tuple(spark.range(1).select(d, ur.public_suffix(d)).first()) == (domain, suffix)


def test_little_evidence_blocks_nobody(spark):
    outcomes = [("bad.spam.net", 0)] * 60 + [("new.spam.net", 0)] + [("good.org", 1)] * 80 + [("one.org", 0)] + [("bad.org", 0)] * 40
    df = spark.createDataFrame(outcomes, "host string, outcome int")
    hosts = spark.createDataFrame([(h,) for h in ["bad.spam.net", "new.spam.net", "good.org", "one.org", "bad.org", "other.org", "x.spam.net", "new.com"]], "host string")
    got = {r["host"]: r for r in ur.host_reputation(df, hosts).collect()}
    assert {h for h, r in got.items() if r["blocked"]} >= {"bad.spam.net", "bad.org"}
    assert not any(got[h]["blocked"] for h in ("good.org", "other.org", "new.com"))
    assert got["x.spam.net"]["mean"] < got["other.org"]["mean"]
    assert got["new.spam.net"]["upper"] > got["bad.spam.net"]["upper"]


def test_a_bad_host_needs_pages(spark):
    """A host that is bad on many pages goes, one with as bad a share of few pages stays; so does one that is a little worse than all."""
    outcomes = [(f"h{i % 30}.com", int(i // 30 % 10 > 0)) for i in range(3000)] + [("bad.net", int(i % 2)) for i in range(100)] + [("few.org", i) for i in range(2)]
    outcomes += [("near.org", int(i % 8 > 0)) for i in range(64)]
    df = spark.createDataFrame(outcomes, "host string, outcome int")
    got = {r["host"]: r["blocked"] for r in ur.host_reputation(df, df.select("host").distinct()).collect()}
    assert got["bad.net"] and not got["few.org"] and not got["near.org"]
    assert sum(got.values()) == 1


def test_odd_rows(spark):
    pages = spark.createDataFrame([(i if i % 4 else None, u, "v", 1) for i, u in enumerate(URLS)] + [(5, URLS[5], "v", 1)], "page_id bigint, url string, verdict string, n int")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 0), (77, 0), (5, 1)], "doc_id bigint, quality int")
    rows = ur.judge_urls(pages, labels, URL_RULES).collect()
    assert len(rows) == len(URLS) + 1 and all(r["verdict"] in ("allow", "block") for r in rows)
    assert len(ur.judge_urls(pages, labels.where(F.lit(False))).where("verdict = 'allow'").collect()) == len(rows)
    assert ur.judge_urls(pages.where(F.lit(False)), labels, URL_RULES).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    ok, message = compare(spark, duck(sf_dir), "op8", QUERIES["op8_url_reputation"], SQL["op8_url_reputation"], sf_dir)
    assert ok, message
    plan = QUERIES["op8_url_reputation"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

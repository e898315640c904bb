import pytest
from pyspark.sql import functions as F

from fathom.llm.url_filter import (
    RULES, Rule, judge, op9_url_filter, page_outcomes, public_suffix, registered_domain, reputation, url_host, url_path,
)


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), tail[:end]


URLS = [None, "", "no scheme", "http://A.Example.ORG/es/1", "https://x.org", "https://x.org/", "http://org/a",
        "http://myorg/a", "http://m.com/fr/2?x=/de/", "http://com/de/#f", "http://É.example.org/en/12", "a://b://c/d",
        "http://example.org?x", "://", "http://a.example.net:8080/p;q/1.html", "http://a.com/de", "http://a.b.co.uk/x"]


def test_parse_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id bigint, url string, host string, rule string")
    got = {r.page_id: r for r in judge(pages, spark.createDataFrame([], "host string, bad int")).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parse(url)
        fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.host + r.path), default=None)
        assert (got[i].host, got[i].path) == (host, path)
        assert got[i].rule == (best.host + best.path if best else None)
        assert got[i].verdict == (best.verdict if best else "allow")


def test_domains(spark):
    cases = {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "b.co.uk": ("co.uk", "b.co.uk"),
             "x.y.com": ("com", "y.com"), "com": ("com", "com"), "": ("", ""), "uk": ("uk", "uk"), "z.uk": ("uk", "z.uk")}
    df = spark.createDataFrame([(h,) for h in cases], "host string").withColumn("s", public_suffix(F.col("host"), ["co.uk"]))
    for r in df.withColumn("d", registered_domain(F.col("host"), F.col("s"))).collect():
        assert (r.s, r.d) == cases[r.host], r.host


def shrunk(hosts):
    """The same estimates by plain loops; hosts: {(suffix, domain, host): (n, k)}."""
    rates = {(): sum(k for _, k in hosts.values()) / sum(n for n, _ in hosts.values())}
    for level in (1, 2, 3):
        groups = {}
        for key, (n, k) in hosts.items():
            a, b = groups.get(key[:level], (0, 0))
            groups[key[:level]] = (a + n, b + k)
        m = {g: rates[g[:-1]] for g in groups}
        up = sum((k - n * m[g]) ** 2 - n * m[g] * (1 - m[g]) for g, (n, k) in groups.items())
        down = sum(n * (n - 1) * m[g] * (1 - m[g]) for g, (n, k) in groups.items())
        s = 1 / min(max(up / down if down else 1e-4, 1e-4), 0.99) - 1
        rates |= {g: (m[g] * s + k) / (s + n) for g, (n, k) in groups.items()}
    return {g[-1]: (r, r - 1.645 * (r * (1 - r) / (s + hosts[g][0] + 1)) ** 0.5) for g, r in rates.items() if len(g) == 3}


def test_reputation(spark):
    hosts = {("com", "a.com", "x.a.com"): (40, 38), ("com", "a.com", "y.a.com"): (2, 1), ("com", "a.com", "z.a.com"): (0, 0),
             ("com", "b.com", "b.com"): (50, 1), ("net", "c.net", "c.net"): (30, 2), ("net", "d.net", "d.net"): (3, 3)}
    rows = [(h[-1], int(i < k) if i < n else None) for h, (n, k) in hosts.items() for i in range(n + 1)]
    got = {r.host: (r.rate, r.low) for r in reputation(spark.createDataFrame(rows, "host string, bad int").repartition(5)).collect()}
    want = shrunk(hosts)
    assert got.keys() == want.keys()
    for h in want:
        assert got[h] == pytest.approx(want[h])
    assert got["z.a.com"][0] > got["b.com"][0]  # borrows from its domain
    pages = spark.createDataFrame([(1, "http://x.a.com/1"), (1, "http://x.a.com/1"), (None, "http://c.net/2")], "page_id bigint, url string")
    out = judge(pages, spark.createDataFrame(rows, "host string, bad int"), rules=[Rule("allow", "org", "/")])
    assert sorted((str(r.page_id), r.verdict) for r in out.collect()) == [("1", "block"), ("1", "block"), ("None", "allow")]


def test_empty_and_no_labels(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert judge(pages, spark.createDataFrame([], "host string, bad int")).count() == 0
    some = spark.createDataFrame([(1, "http://a.b/3")], "page_id bigint, url string")
    labels = spark.createDataFrame([(None, 1, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")
    assert [r.verdict for r in judge(some, page_outcomes(some, labels)).collect()] == ["allow"]


def test_query_against_sql(spark):
    from fathom.llm.queries import ORACLES, QUERIES
    from suite import check

    con = check.connect("/root/testdata/sf0.01")
    old = dict(check.QUERIES), dict(check.ORACLES)
    try:
        check.QUERIES["op9_url_filter"], check.ORACLES["op9_url_filter"] = QUERIES["op9_url_filter"], ORACLES["op9_url_filter"]
        assert check.compare(spark, con, "op9_url_filter", "/root/testdata/sf0.01") is None
    finally:
        check.QUERIES.clear(), check.QUERIES.update(old[0]), check.ORACLES.clear(), check.ORACLES.update(old[1])
    assert op9_url_filter(spark, "/root/testdata/sf0.01").filter("by = 'reputation'").count()

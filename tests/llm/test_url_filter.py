import re

import pytest

from paddock.llm import url_filter

SCHEMA = "page_id long, url string, html string, site string, listed boolean, key string"
URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "https://A.Example.NET/en/1?x=/fr/", "http://a.org/fr/x",
    "http://a.org/FR/x", "http://example.com/de/1", "http://www.example.com/de", "http://x.example.com?y://z.org/fr/",
    "http://casino-win.example.com/en/", "http://m.casino-win.example.com#a", "http://thecasinos.example.com/",
    "http://notnet/", "ftp://blog.b.org", "http://\u0130.net/", "http://x.net//", "a://b://c.net/",
]


def verdict(url, listed):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (r, v)
        for r, v in url_filter.RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    rule, said = max(fits, key=lambda x: len(x[0]), default=(None, None))
    site = re.sub(r"^(www|m|blog)\.", "", host)
    return host, path, rule, said or ("block" if site in listed else "allow")


@pytest.mark.parametrize("max_words", [1 << 20, 1])
def test_like_brute_force(spark, max_words):
    data = [(i % 15 or None, u, "x", "s", True, "k") for i, u in enumerate(URLS)] * 2
    pages = spark.createDataFrame(data, SCHEMA).repartition(3)
    listed = {"casino-win.example.com", "b.org", "absent.example"}
    keys = spark.createDataFrame([(k,) for k in [*listed, "b.org"]], "key string")
    found = url_filter.judge(pages, keys, max_words=max_words).collect()
    key = lambda r: tuple(map(str, r))
    want = [(d[0], *verdict(d[1], listed)) for d in data]
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_cascade_is_exact(spark):
    universe = url_filter.materialize(spark.range(20_000).selectExpr("concat('site', id) as key"), "keys")
    listed = url_filter.materialize(universe.where("xxhash64(key) % 10 = 0"), "listed")
    levels = url_filter.cascade(universe, listed)
    assert len(levels) > 2
    said = universe.withColumn("in", url_filter.in_cascade(universe["key"], levels)).where("in").select("key")
    assert said.exceptAll(listed).count() == listed.exceptAll(said).count() == 0
    bits = sum(level.size for level in levels) * 64
    assert bits < 20 * listed.count()


def test_no_join_and_no_python(spark):
    rows = url_filter.materialize(spark.range(50).selectExpr("concat('s', id % 9) as site"), "rows")
    out = url_filter.marked(rows, "site", spark.createDataFrame([("s1",), ("s2",)], "key string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
    assert {r["site"] for r in out.where("listed").collect()} == {"s1", "s2"}


def test_empty(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert url_filter.judge(pages, spark.createDataFrame([], "key string")).count() == 0
    assert url_filter.sites_with(pages, ["casino"]).count() == 0

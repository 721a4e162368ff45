import pytest

from memberfold.llm import oracles, url_reputation
from memberfold.llm.queries import ALLOW, BLOCK

URLS = [
    None, "", "no scheme", "://", "http://", "http://a.example.net/en/1", "https://EXAMPLE.net", "http://example.net/en",
    "http://x.net/de?q=/en/", "http://x.org/fr/1#top", "ftp://org/fr/", "http://example.com/de/x", "http://É.Example.COM/de/",
    "http://notexample.com/de/", "http://a.co.uk/x", "http://b.a.co.uk", "http://u@h:80/p/", "x://y://z/net/", "http://h?a://b/c",
    "http://h#f", "line\nbreak://host.net/en/",
]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def rule_of(host, path):
    fits = [
        r for r in (*BLOCK, *ALLOW)
        for h, p in [r.split("/", 1)]
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
    ]
    return max(fits, key=len, default=None)


@pytest.fixture
def judged(spark):
    pages = spark.createDataFrame([(k, u, "extra") for k, u in enumerate(URLS)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(4, True), (5, False), (5, None), (None, True)], "page_id long, good boolean")
    return {r["page_id"]: r for r in url_reputation.judge_urls(pages, outcomes, BLOCK, ALLOW).collect()}


def test_host_path_and_rule_of_odd_urls(judged):
    assert len(judged) == len(URLS)
    for k, url in enumerate(URLS):
        host, path = host_path(url)
        rule = rule_of(host, path)
        assert (judged[k]["host"], judged[k]["path"], judged[k]["rule"]) == (host, path, rule)
        if rule:
            assert judged[k]["verdict"] == ("block" if rule in BLOCK else "allow")


def test_bad_host_is_blocked_and_good_ones_are_not(spark, sql):
    rows = [(k, f"http://bad.example.com/{k}", k % 50 == 0) for k in range(400)]
    rows += [(1000 + k, f"http://h{k % 40}.example.com/{k}", k % 9 != 0) for k in range(2000)]
    pages = spark.createDataFrame([r[:2] for r in rows] + [(5000, "http://new.example.com/")], "page_id long, url string")
    outcomes = spark.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, good boolean")
    found = url_reputation.judge_urls(pages, outcomes, BLOCK, ALLOW).collect()
    assert {r["host"] for r in found if r["verdict"] == "block"} == {"bad.example.com"}
    labels = outcomes.selectExpr("page_id AS doc_id", "CAST(good AS int) AS quality")
    want = sql(oracles.url_reputation(BLOCK, ALLOW), pages=pages, labels=labels)
    key = lambda r: (r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
    assert sorted(map(str, map(key, want))) == sorted(map(str, map(key, found)))


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    outcomes = spark.createDataFrame([], "page_id long, good boolean")
    assert url_reputation.judge_urls(pages, outcomes, BLOCK, ALLOW).count() == 0
    one = spark.createDataFrame([(None, "http://a.b/")], "page_id long, url string")
    assert url_reputation.judge_urls(one, outcomes, BLOCK, ALLOW).first()["verdict"] == "allow"

import duckdb

from partwise.llm.queries import ORACLE, URL_RULES, op9_url_filters
from partwise.llm import url_filters
from partwise.llm.url_filters import filter_urls


def judge(url, rules, default="allow"):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


def test_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    key = lambda r: tuple((x is None, x) for x in r)
    found = sorted(map(tuple, op9_url_filters(spark, sf_dir).collect()), key=key)
    assert found == sorted(con.execute(ORACLE["op9_url_filters"]).fetchall(), key=key)


def test_edges(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/es/x", "http://example.org", "http://example.org?x=/es/", "https://a.b.example.org/en/1",
        "http://example.org/en/12#f", "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/?q", "http://com/de/", "http://x.com:80/de/",
        "a://b://c/d", "http://org/", "http://é.org/", "http://x.org/" + "y" * 100_000, "http://" + "a." * 5000 + "com/fr/z", "http://x.com/fr/", "http://ÄB.ORG/",
    ]
    extra = [("", "", "block"), ("x.com", "/fr/", "block"), ("x.com", "/fr/", "allow"), ("b.example.org", "/", "allow")]
    rows = [(i if i % 4 else None, u) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as rule", "3 as row", "4 as id")
    for rules in (URL_RULES, URL_RULES + extra, []):
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        found = [tuple(r) for r in filter_urls(pages, table).collect()]
        assert sorted(found, key=str) == sorted([(i, *judge(u, rules)) for i, u in rows], key=str)
    assert filter_urls(pages.limit(0), table).count() == 0


def test_prefixes_meet_and_digests_confirm(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "PREFIX_DIGITS", 1)  # nearly every expression meets some wrong rule
    rules = [(f"h{i % 20}.org", "/" + "abc"[: i % 4], "block" if i % 3 else "allow") for i in range(60)]
    rows = [(i, f"http://{'s.' * (i % 3)}h{i % 25}.org/{'abcd'[: i % 5]}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(i, *judge(u, set(rules))) for i, u in rows], key=str)
    keys = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert keys and all("e_prefix" in k and "e_digest" not in k for k in keys)

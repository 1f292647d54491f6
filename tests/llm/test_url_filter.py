import random

from candles.llm import url_filter


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:].split("#")[0].split("?")[0]
    best = None
    for action, h, p in rules:
        if None in (action, h, p):
            continue
        h = h.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1, -1, "", ""), (len(h), len(p), action, h + p))
    return (host, path, best[3] if best else None, best[2] if best else default)


def test_against_every_rule(spark):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "org", "Example.ORG", "", "a..com", "c-d.a.com", "a.com:80"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/é/", "//", "/x/y/z?q=/x#f", "?a", "#b"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths[:8])) for _ in range(40)]
    rules += [(None, "com", "/"), ("block", None, "/"), ("allow", "com", None)]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "a.com/x", "x://", "a://b://c/d", "h://q\nr/s"]
    urls += ["http://b.a.com/x/y"] * 300
    pages = spark.createDataFrame([(i % 90, u, "k") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = url_filter.judge(pages, spark.createDataFrame(rules, "action string, host string, path string")).collect()
    want = sorted(((i % 90, *plain(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "action string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, none, default="block").collect()] == [(1, "a.b", "/c", None, "block")]
    assert url_filter.judge(pages.limit(0), none).collect() == []


def test_a_key_that_many_hosts_share_is_judged_once(spark, monkeypatch):
    kept, counts = url_filter.stored, {}

    def counted(df, name):
        made = kept(df, name)
        counts[name] = made.count()
        return made

    monkeypatch.setattr(url_filter, "stored", counted)
    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://h', id, '.com/') as url")
    rules = spark.createDataFrame([("block", "com", "/"), ("allow", "h7.com", "/")], "action string, host string, path string")
    got = url_filter.judge(pages, rules).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in got} == {"block": 2999, "allow": 1}
    assert counts["url-keys"] == 3001

"""URL parts and listed rules against plain code; mined rules against counting every combination."""

import itertools
import re

from pyspark.sql import functions as F

from tidemark.llm import urls
from tidemark.llm.queries import URL_RULES

ODD = [
    None, "", "no scheme/at/all", "://", "http://", "http://A.Example.COM", "http://a.example.com/en/x?y=/en/", "x://net/es/",
    "http://b.net/es/1#t", "http://b.net/es", "http://www.example.com/en/a", "http://deep.www.example.com/en/",
    "http://notexample.com/en/", "http://example.com?en/", "http://example.com/fr/#a", "a://b://c/d", "http://é.com/Ä b/",
    "http://x.net/fr/\nnext", "HTTP://Ünet.NET/fr/2", "http://u@example.com:80/en/", "http://example.com/en/" + "z" * 20_000,
    "http://example.com/fr/#a", "http://example.com/fr/#a",
]


def plain(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in URL_RULES:
        own, start = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, best


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, "other", "mine") for i, u in enumerate(ODD)], "page_id int, url string, host string, token string")
    none = urls.mined(spark.createDataFrame([], "url string, bad boolean"))
    got = {r.page_id: r for r in urls.judged(pages, none, URL_RULES).collect()}
    assert len(got) == len(ODD)
    for i, url in enumerate(ODD):
        host, path, best = plain(url)
        row = got[i]
        assert (row.host, row.path, row.rule) == (host, path, best and best[0]), url
        assert row.verdict == (best[1] if best else "allow")
        assert row.token == "mine"


def labelled():
    bad = [(f"http://ads.x{i % 3}.org/promo/{i}?ref=a", True) for i in range(30)]
    mixed = [(f"http://ads.y{i % 5}.org/{'promo' if i % 2 else 'help'}/{i}", i % 4 == 1) for i in range(40)]
    good = [(f"https://news.z{i % 7}.org/story/{i}", False) for i in range(60)]
    return bad + mixed + good + [(None, True), ("no url", True), ("http://a.org/x", None)] + good[:5]


def plain_rules(rows, least, confidence, lift):
    known = [(u, b) for u, b in rows if u and "://" in u and b is not None]
    return known, sum(b for _, b in known) / len(known)


def test_mined_rules_equal_counting_every_combination(spark):
    rows = labelled()
    df = spark.createDataFrame(rows, "url string, bad boolean")
    known, share = plain_rules(rows, 5, 0.5, 1.5)
    found = df.filter("url LIKE '%://%' AND bad IS NOT NULL").select("bad", urls.tokens(df.url).alias("t")).collect()
    count, bad = {}, {}
    for r in found:
        for k in range(1, len(r.t) + 1):
            for items in itertools.combinations(sorted(r.t), k):
                count[items] = count.get(items, 0) + 1
                bad[items] = bad.get(items, 0) + r.bad
    sure = {i: bad[i] / n for i, n in count.items() if n >= 5 and bad[i] / n >= 0.5 and bad[i] / n / share >= 1.5}
    want = {i for i in sure if not any(set(j) < set(i) and sure[j] >= sure[i] for j in sure)}
    rules = urls.mined(df, min_support=0.0, min_urls=5, min_confidence=0.5, min_lift=1.5)
    assert {tuple(r["items"]) for r in rules.collect()} == want and want
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id int, url string")
    tokens = {r.url: set(r.t or ()) for r in df.select("url", urls.tokens(df.url).alias("t")).distinct().collect()}
    for r in urls.judged(pages, rules, ()).collect():
        fits = [i for i in want if r.url and set(i) <= tokens[r.url]]
        assert r.verdict == ("block" if fits else "allow")
        if fits:
            assert r.confidence == max(sure[i] for i in fits)


def test_a_bad_host_stays_a_rule_as_data_grow_and_a_doubtful_one_is_none(spark):
    few = [(f"http://bad.org/{'ab'[i % 2]}/x{i}", True) for i in range(6)]
    few += [(f"http://half.net/{'ab'[i % 2]}/y{i}", i < 4) for i in range(6)]
    for n in (100, 8000):
        good = [(f"https://good.z{i % 7}.com/s/{i}", False) for i in range(n)]
        df = spark.createDataFrame(few + good, "url string, bad boolean")
        rules = urls.mined(df, certain=urls.CERTAIN).collect()
        assert any(set(r["items"]) & {"d:bad.org", "h:bad"} for r in rules), n
        assert not any(set(r["items"]) & {"d:half.net", "h:half"} for r in rules), n


def test_long_urls_that_are_there_a_few_times(spark):
    """Sixty segments and forty query keys, five times: each token that only they have is a rule, and nothing else."""
    deep = "http://deep.org/" + "/".join(f"seg{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    deep += "?" + "&".join(f"k{i}=1" for i in range(40))
    rows = [(deep, True)] * 5 + [(f"http://good.z{i % 7}.org/s/{i}", False) for i in range(60)]
    rules = urls.mined(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    got = {tuple(r["items"]) for r in rules}
    own = {t for r in spark.createDataFrame([(deep,)], "url string").select(urls.tokens(F.col("url")).alias("t")).collect() for t in r.t}
    assert got == {(t,) for t in own - {"s:http", "h:org"}} and len(got) == 102
    assert {(r.confidence, r.urls) for r in rules} == {(1.0, 5)}


def test_rules_of_tokens_alike_are_spelled_out(spark):
    """Two groups of tokens, each also on good URLs, of which only both together are sure."""
    rows = [("http://a.org/p/q?x=&y=", True)] * 6 + [("http://b.org/p/q", False)] * 6 + [("http://c.org/?x=&y=", False)] * 6
    rows += [("http://a.org/z", False)] * 6
    rules = urls.mined(spark.createDataFrame(rows, "url string, bad boolean"), min_confidence=0.9).collect()
    want = {(p, q) for p in ("p:p", "p:q") for q in ("q:x", "q:y")}
    want |= {tuple(sorted((a, t))) for a in ("d:a.org", "h:a") for t in ("p:p", "p:q", "q:x", "q:y")}
    assert {tuple(r["items"]) for r in rules} == want


def test_a_column_with_the_name_of_a_mark_stays(spark):
    pages = spark.createDataFrame([("http://a.org/", "mine")], "url string, _listed string")
    none = urls.mined(spark.createDataFrame([], "url string, bad boolean"))
    got = urls.judged(pages, none, URL_RULES).select("_listed", "verdict").collect()
    assert [tuple(r) for r in got] == [("mine", "allow")]


def test_no_labels_give_no_rules(spark):
    assert urls.mined(spark.createDataFrame([("http://a.org/", False)], "url string, bad boolean")).count() == 0
    pages = spark.createDataFrame([], "page_id int, url string")
    assert urls.judged(pages, urls.mined(spark.createDataFrame(labelled(), "url string, bad boolean")), URL_RULES).count() == 0

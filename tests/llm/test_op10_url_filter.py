import re

from conftest import SF, lower_ascii

from gaugeline.llm import url_filter as op
from gaugeline.llm.queries import QUERIES, URL_RULES

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),  # fixed values of the contract
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower_ascii(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


ODD = [None, "", "no scheme/x", "http://", "HTTP://A.COM", "http://a.com/", "http://a.com?x=/",
       "http://EXAMPLE.com/en/1#f", "http://www.example.com/en/", "http://m.www.example.com/en/x?y",
       "http://badexample.com/en/", "http://x.net/es/a", "http://net/fr/", "http://x.net/esx",
       "a://b://c/d", "http://com:80/", "http://é.com/é/\n?q", "http://x.com/" + "a" * 30_000]


def test_rules_as_brute_force(spark):
    df = spark.createDataFrame([(u, "clash", 1) for u in ODD + ODD], "url string, rule string, n int")
    got = op.judge(df, URL_RULES, op.UrlModel((3,), None)).collect()
    assert len(got) == 2 * len(ODD)
    for r in got:
        host, path, rule, verdict = brute(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or "allow") and r["n"] == 1


def test_query(spark):
    urls = dict(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect())
    rows = QUERIES["op10_url_filter"](spark, SF).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ((verdict,) if verdict else ("allow", "block"))


def test_learned_verdicts_on_held_out_urls(spark):
    urls = [(f"http://site{k}.org/{'casino/win' if k % 2 else 'library/read'}/{k}",
             "block" if k % 2 else "allow") for k in range(200)]
    train = spark.createDataFrame(urls[:120] + [(None, "block"), ("http://x", None)],
                                  "url string, verdict string")
    test = spark.createDataFrame(urls[120:], "url string, want string")
    rows = op.judge(test, (), op.train(train)).collect()
    assert sum(r["verdict"] == r["want"] for r in rows) >= 78
    assert op.judge(test, (), op.train(train.where("verdict = 'block'"))).first()["verdict"] == "block"
    assert op.judge(test.limit(0), URL_RULES, op.train(train.limit(0))).count() == 0

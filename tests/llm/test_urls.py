import re

import numpy as np
from posgraph.llm import urls

from tests.conftest import SF_SMALL
from tests.llm.util import lower_ascii, rows


def pages(spark, pairs, clashes=False):
    if clashes:
        return spark.createDataFrame([(*p, "h", "r", "s", "f") for p in pairs],
                                     "page_id long, url string, host string, rule string, score string, features string")
    return spark.createDataFrame(pairs, "page_id long, url string")


def brute(page_id, url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = lower_ascii(re.match(r"[^/?#]*", rest).group())
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (page_id, host, path, best and best[2], best and best[3])


def judged(spark, df):
    return urls.judge(df, urls.rule_table(spark), urls.train(urls.labelled_table(spark)))


def check(spark, pairs, df):
    got = rows(judged(spark, df), "page_id", "host", "path", "rule", "verdict")
    want = sorted((brute(*p) for p in pairs), key=repr)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert all(g[4] == w[4] if w[4] else g[4] in ("allow", "block") for g, w in zip(got, want, strict=True))


def test_sample_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    check(spark, [tuple(r) for r in df.select("page_id", "url").collect()], df)


def test_odd_urls_and_clashing(spark):
    pairs = [(1, None), (2, ""), (3, "no scheme.com/en/"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/x?y#z"),
             (6, "http://a.example.com/en/"), (7, "http://example.com/EN/"), (8, "x://y.net/es/1"), (9, "x://net/es/"),
             (10, "x://com"), (11, "x://com/"), (12, "a://b.com://c.net/es/"), (13, "x://a.b.net?/es/"),
             (14, "x://www.example.com.net/fr/"), (15, "http://xexample.com/en/"), (None, "http://m.org/fr/"),
             (16, "http://h.org/" + "p" * 100_000), (17, "http://É.org/fr/\n/x"), (8, "x://y.net/es/1"), (18, "x://.com/")]
    check(spark, pairs, pages(spark, pairs, clashes=True))


def test_model_ranks_unseen_hosts(spark):
    bad = ["http://casino-win.example.org/en/1", "https://m.adult-x.example.org/de/22", "http://cheap-pills.example.org/3",
           "https://www.spam-farm.example.org/en/4", "http://free-bets.example.org/en/5"]
    good = ["http://museum-guide.example.org/en/1", "https://m.history-notes.example.org/de/22",
            "http://the-weather.example.org/3", "https://www.library-news.example.org/en/4", "http://ththre.example.org/en/5"]
    got = {r["page_id"]: r["score"] for r in judged(spark, pages(spark, list(enumerate(bad + good)))).collect()}
    assert np.mean([got[i] > got[5 + j] for i in range(5) for j in range(5)]) >= 0.9


def test_without_labels_and_empty(spark):
    one = urls.labelled_table(spark).where("label = 0")
    assert urls.train(one) is None
    got = urls.judge(pages(spark, [(1, "http://casino.example.org/")]), urls.rule_table(spark), None).collect()
    assert [(r["verdict"], r["score"]) for r in got] == [("allow", 0.0)]
    assert judged(spark, pages(spark, [])).count() == 0


def test_equally_long_rules_block_first(spark):
    rules = urls.rule_table(spark, [("a.org", "/x", "allow"), ("a.org", "/x", "block")])
    got = urls.judge(pages(spark, [(1, "http://a.org/x")]), rules, None).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [("a.org/x", "block")]


def test_equally_long_rules_by_name(spark):
    for order in (1, -1):
        rules = urls.rule_table(spark, [("z.com", "/xy", "block"), ("a.z.com", "/", "block")][::order])
        got = urls.judge(pages(spark, [(1, "http://a.z.com/xy")]), rules, None).collect()
        assert [(r["rule"], r["verdict"]) for r in got] == [("a.z.com/", "block")]


def test_plan_has_no_python(spark):
    plan = judged(spark, spark.read.parquet(f"{SF_SMALL}/pages.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan

import re

import helpers
from clinflat.llm import url_filter as U
from clinflat.llm.queries import (
    ALLOWED_URLS,
    BLOCKED_URLS,
    ORACLES,
    URL_RULES,
    labelled_urls,
    op2_url_filter,
)
from oracle import compare, connect

URLS = [
    None, "", "no scheme", "http://A.Net", "http://a.net/x?y#z", "https://www.example.net/en/1",
    "http://example.net/english", "x://sub.EXAMPLE.com/de/5?q=/en/", "http://badexample.com/de/5",
    "http://b.org/fr/#t", "http://b.org/fr", "http://b.org?x=://c.net/", "http://üñî.org/é/ß",
    "http://", "://h/p", "http://h\n.org/p\nq", "http://net/", "a" * 3000 + "://" + "b" * 3000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for _, rule in URL_RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rows = U.judge(pages, labelled_urls(spark), URL_RULES).orderBy("page_id").collect()
    verdicts = dict((r, v) for v, r in URL_RULES)
    for r, url in zip(rows, URLS):
        assert (r["host"], r["path"], r["rule"]) == plain(url)
        assert r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1
        if r["rule"]:
            assert r["verdict"] == verdicts[r["rule"]]


def test_unseen_urls(spark):
    fresh = {
        "http://casino-lounge.example.com/en/5": "block", "http://www.free-bets.example.com/1": "block",
        "https://cheap-pills-now.example.com/de/9": "block", "http://blog.spam-farm.example.org/en/2": "block",
        "https://adult-x.example.com/fr/4": "block", "http://ads-track.example.com/es/88": "block",
        "https://www.thenation.example.org/en/99": "allow", "http://thstion.example.com/fr/31": "allow",
        "https://blog.ththe.example.org/en/6?utm_source=feed": "allow", "http://m.therand.example.com/es/2": "allow",
    }
    pages = spark.createDataFrame(list(enumerate(fresh)), "page_id long, url string")
    rows = U.judge(pages, labelled_urls(spark), []).orderBy("page_id").collect()
    assert [r["verdict"] for r in rows] == list(fresh.values())


def test_weights_are_those_of_gradient_descent_on_features(spark):
    import numpy as np

    labelled = labelled_urls(spark)
    host, path = U.host_and_path(labelled["url"])
    rows = labelled.select("blocked", U.features(host, path).alias("x")).collect()
    x = np.zeros((len(rows), U.BUCKETS))
    for k, r in enumerate(rows):
        x[k, r["x"]] = 1 / np.sqrt(len(r["x"]))
    y = np.array([r["blocked"] for r in rows], float)
    w, b = np.zeros(U.BUCKETS), 0.0
    for _ in range(U.STEPS + 1):
        error = y - 1 / (1 + np.exp(-(x @ w + b)))
        w = w * (1 - U.RATE * U.DECAY) + U.RATE / len(y) * x.T @ error
        b += U.RATE / len(y) * error.sum()
    model = U.train(labelled).first()
    assert np.allclose(model["weights"], w, atol=1e-9) and abs(model["bias"] - b) < 1e-9
    assert (((x @ w + b) > 0) == (y == 1)).mean() > 0.95


def test_awkward_tables(spark):
    none = spark.createDataFrame([], "url string, blocked int")
    pages = spark.createDataFrame(
        [(None, None, "h"), (1, "http://a.net/b", "h"), (1, "http://a.net/b", "h")],
        "page_id long, url string, host string",
    )
    rows = U.judge(pages, none, URL_RULES).collect()
    assert sorted(r["verdict"] for r in rows) == ["allow", "block", "block"]
    assert U.judge(pages.limit(0), labelled_urls(spark), URL_RULES).count() == 0
    odd = labelled_urls(spark).unionByName(
        spark.createDataFrame([(None, 1), ("http://q", None)], "url string, blocked int")
    )
    twice = odd.unionByName(labelled_urls(spark))
    assert U.train(twice).first() == U.train(labelled_urls(spark)).first()
    small = U.train(labelled_urls(spark), max_labelled=10).first()
    assert sum(w != 0 for w in small["weights"]) > 0


def test_query(spark):
    assert not set(BLOCKED_URLS) & set(ALLOWED_URLS)
    con = connect(helpers.SF)
    assert compare(op2_url_filter(spark, helpers.SF), con, ORACLES["op2_url_filter"]) == []

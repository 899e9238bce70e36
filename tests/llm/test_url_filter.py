"""op 2: hosts, rules, boundaries; a naive search as brute force."""

import re

from tidemart.llm import urlfilter


def _naive(url, terms):
    return {t for t in terms if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", url.lower())}


def test_split():
    assert urlfilter.split("HTTP://WWW.Ex.Org/A?b#c") == ("www.ex.org", "/A")
    assert urlfilter.split("x://h?q/r") == ("h", "")
    assert urlfilter.split("x://h#/r") == ("h", "")
    assert urlfilter.split("no scheme/") == urlfilter.split("") == ("", "")
    assert urlfilter.split("a://") == ("", "")
    assert urlfilter.split("a://b://c/d") == ("b:", "//c/d")


def test_rules_longest_wins_and_cover_subdomains():
    judge = urlfilter.Judge(urlfilter.RULES, urlfilter.STRICT, urlfilter.SOFT, 2)
    for url, rule, verdict in (
        ("http://a.org/x", "org/", "allow"), ("http://example.org/es/1", "example.org/es/", "block"), ("http://m.example.org/en/12", "example.org/en/1", "block"),
        ("http://notexample.org/es/1", "org/", "allow"), ("http://a.com/fr/xxx", "com/fr/", "allow"), ("http://a.com/de/", "com/de/", "block"),
        ("http://org", None, "allow"), ("http://com/es/", None, "allow"), ("http://a.net/xxx", None, "block"), ("http://a.net/bet-win", None, "block"), ("http://a.net/bet", None, "allow"), ("http://a.net/bet?bet", None, "allow"),
    ):
        got = judge(url)
        assert (got[2], got[3]) == (rule, verdict), url


def test_hits_equal_a_naive_search():
    judge = urlfilter.Judge((), urlfilter.STRICT, urlfilter.SOFT, 2)
    for url in ("http://porno.porn/SEXCAM", "adultbet bet.adult", "winner-win", "xxxx", "éxxxé", "a9xxx", "hot", "", "://", "SLOTS_slots", "bet/betting/bet-ting"):
        assert judge.hits(url) == (len(_naive(url, urlfilter.STRICT)), len(_naive(url, urlfilter.SOFT))), url


def test_table(spark):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (None, "http://a.b.ORG/p?q", "c", 3), (2, "http://x.net/" + "porn/" * 9000, None, None)]
    out = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string, verdict int"))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "n_strict", "n_soft"]
    got = {(r.page_id, r.host, r.rule, r.verdict, r.n_strict) for r in out.collect()}
    assert got == {(1, "", None, "allow", 0), (2, "", None, "allow", 0), (None, "a.b.org", "org/", "allow", 0), (2, "x.net", None, "block", 1)}
    assert urlfilter.judge_urls(out.limit(0)).count() == 0


def test_vocabulary_follows_from_its_stems():
    assert len(urlfilter.STRICT) + len(urlfilter.SOFT) > 300 and not set(urlfilter.STRICT) & set(urlfilter.SOFT)
    assert urlfilter.vocabulary(["a", "b", "a"], ("", "s")) == ("a", "as", "b", "bs")
    judge = urlfilter.Judge((), urlfilter.STRICT, urlfilter.SOFT, 2)
    for url, verdict in (
        ("http://a.net/casinos/", "block"), ("http://cheap-pills.net/x", "block"), ("http://freebets.net/", "allow"), ("http://free-bets.net/", "block"),
        ("http://blog.net/free/download", "allow"), ("http://a.net/deals?coupon=1", "block"), ("http://a.net/winter/trackers", "allow"),
    ):
        assert judge(url)[3] == verdict, url


def test_soft_hits_decide_in_a_table(spark):
    """Pages that no strict term, but several soft ones block."""
    out = urlfilter.judge_urls(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")).collect()
    soft = [r for r in out if r.rule is None and r.n_strict == 0 and r.n_soft >= 2]
    assert len(soft) > 10 and all(r.verdict == "block" for r in soft)
    assert sum(r.verdict == "block" for r in out if r.rule is None) < 0.2 * len(out)

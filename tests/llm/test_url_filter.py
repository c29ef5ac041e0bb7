"""Rules and the language-model ratio against plain Python."""

import math
import random
from collections import Counter

import pytest

from orderlake.llm import url_filter

SCHEMA = "page_id bigint, url string"
URLS = [
    "http://example.org/es/x", "http://EXAMPLE.org/en/12?q=/es/", "https://sub.example.org/en/1", "http://a.org/", "http://a.org",
    "http://com/fr/x", "http://x.com/fr/", "http://x.com/de/#a", "http://xcom/fr/", "ftp://y.com/en/", None, "", "no scheme",
    "http://x.com:80/fr/", "//x.org/", "http://a://b.org/x", "http://x.org/é?é", "http://x.com/fr", "x://\n.org/",
]


def brute(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, allow in url_filter.RULES:
        domain, prefix = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == domain or host.endswith("." + domain)) and path.startswith(prefix) and (not best or len(rule) > len(best[0])):
            best = rule, allow
    return host, path, best


def test_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), SCHEMA)
    for r in url_filter.judge(df).collect():
        host, path, best = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]), r.url
        assert r.verdict in ("allow", "block")
        if best:
            assert r.verdict == ("allow" if best[1] else "block") and r.score is None
        else:
            assert r.score is not None


def test_markov_probabilities_sum_to_one_and_back_off():
    counts = Counter()
    for text in ("abcabc", "abd", "é"):
        s = "\x00" * 2 + url_filter._bytes(text)
        for size in (1, 2, 3):
            counts.update(s[i - size + 1:i + 1] for i in range(2, len(s)))
    m = url_filter.Markov.of(counts, 2)
    for context in ("", "a", "ab", "zz"):
        total = sum(math.exp(m.log_likelihood(context + chr(b)) - m.log_likelihood(context)) for b in range(256))
        assert total == pytest.approx(1)
    assert m.log_likelihood("abc") > m.log_likelihood("cba") > m.log_likelihood("xyz")


def test_learns_from_rules(spark):
    rng = random.Random(1)

    def name(letters):
        return "".join(rng.choice(letters) for _ in range(8))

    pages = [(i, f"http://{name('aeiou')}.org/{name('aeiou')}") for i in range(300)]
    pages += [(300 + i, f"http://{name('xyzq')}.com/de/{name('xyzq')}") for i in range(300)]
    pages += [(600 + i, f"http://{name(('aeiou', 'xyzq')[i % 2])}.net/{name(('aeiou', 'xyzq')[i % 2])}") for i in range(100)]
    got = url_filter.judge(spark.createDataFrame(pages, SCHEMA).repartition(4)).where("rule IS NULL").collect()
    assert all(r.verdict == ("allow", "block")[r.page_id % 2] for r in got) and len(got) == 100
    again = url_filter.judge(spark.createDataFrame(pages, SCHEMA).repartition(2)).where("rule IS NULL").collect()
    assert {(r.page_id, r.score) for r in got} == {(r.page_id, r.score) for r in again}


def test_gram_counts(spark):
    df = spark.createDataFrame([("abab", True)] * 5 + [("abab", False), (None, True), ("", True)], "text string, accepted boolean")
    got = {(r.accepted, bytes(r.gram)): r.n for r in url_filter.gram_counts(df.repartition(3), 1).collect()}
    assert got[True, b"a"] == 10 and got[True, b"ab"] == 10 and got[True, b"ba"] == 5 and got[False, b"\x00a"] == 1


def test_no_examples_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://x.net/")], SCHEMA)
    assert [(r.verdict, r.score) for r in url_filter.judge(df).collect()] == [("allow", 0.0)]
    assert url_filter.judge(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "http://x.net/" + "a" * 100_000), (2, "http://x.org/"), (3, "http://x.com/de/")], SCHEMA)
    assert url_filter.judge(long.selectExpr("*", "'x' AS text", "'y' AS accepted")).count() == 3


def plain_scores(examples, texts, order=url_filter.ORDER):
    """From two whole models in plain Python, by examples (text, accepted) that aren't held out."""
    models = []
    for kind in (True, False):
        counts = Counter()
        for text, accepted in examples:
            if accepted == kind:
                s = "\x00" * order + url_filter._bytes(text)
                for size in range(1, order + 2):
                    counts.update(s[i - size + 1:i + 1] for i in range(order, len(s)))
        models.append((url_filter.Markov.of(counts, order), len(counts)))
    (a, _), (r, _) = models
    return {t: (a.log_likelihood(url_filter._bytes(t)) - r.log_likelihood(url_filter._bytes(t))) / max(1, len(url_filter._bytes(t)))
            for t in texts}, [n for _, n in models]


def test_every_gram_counts_beyond_the_broadcast_bound(spark, monkeypatch):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-_.~%&=+"

    def name(n):
        return "".join(rng.choice(letters) for _ in range(n))

    known = [f"http://x.org/{name(60)}" for _ in range(4000)]
    pages = known + [f"http://x.com/de/{name(60)}" for _ in range(400)]
    # Half of the undecided ones repeat stretches of accepted urls, which only their rare n-grams tell.
    pages += [f"http://x.net/{k[20:60]}" for k in known[:100]] + [f"http://x.net/{name(40)}" for _ in range(100)]
    pages += [f"http://x.net/{known[0][20:60]}"] * 50 + [None, "", "é"]
    df = spark.createDataFrame(list(enumerate(pages)), SCHEMA).repartition(4)
    host, path = url_filter.host_and_path(df["url"])
    held = url_filter.F.pmod(url_filter.F.xxhash64("text"), url_filter.F.lit(url_filter.HELD_OUT)) == 0
    text = df.select("page_id", url_filter.model_text(df["url"]).alias("text"), url_filter.matching_rule(host, path)[1].alias("accepted"))
    examples = [(r.text, r.accepted) for r in text.where("accepted IS NOT NULL").where(~held).collect()]
    undecided = {r.page_id: r.text for r in text.where("accepted IS NULL").collect()}
    expected, sizes = plain_scores(examples, set(undecided.values()))
    assert max(sizes) > 200_000

    def judged():
        return {r.page_id: (r.score, r.verdict) for r in url_filter.judge(df).collect()}

    whole = judged()
    assert len(whole) == len(pages) and {i for i, (s, _) in whole.items() if s is not None} == set(undecided)
    for i, t in undecided.items():
        assert whole[i][0] == pytest.approx(expected[t], abs=1e-9)
    for bound in (300, 0):
        monkeypatch.setattr(url_filter, "FAST_WINDOWS", bound)
        assert judged() == whole


def test_clashing_columns_stay(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(i, f"http://a{i}.{d}/x{i}") for i, d in enumerate(["org", "net", "com", "de"] * 5)], "page_id bigint, url string")
    plain = {r.page_id: (r.host, r.path, r.rule, r.score, r.verdict) for r in url_filter.judge(pages).collect()}
    extra = pages.withColumns({c: F.lit(f"own {c}") for c in (*url_filter.JUDGED, "_row", "_text", "_key", "text", "accepted")})
    got = url_filter.judge(extra)
    assert got.columns == [*extra.columns, *[f"_{c}" for c in url_filter.JUDGED]]
    for r in got.collect():
        assert tuple(r[f"_{c}"] for c in url_filter.JUDGED) == plain[r.page_id]
        assert all(r[c] == f"own {c}" for c in (*url_filter.JUDGED, "_row", "_text", "_key"))

import random
import time

import pytest

from sigweave.llm import url_filter

URLS = [
    "https://Example.NET/en/1?x#y", "http://a.b.example.net/de/", "https://example.net", "https://notexample.net/en/", "http://example.org/fr/2", "ftp://org/fr/", "http://sub.example.com/de/3#t",
    "http://casino-win.example.com/en/", "https://m.free-bets.example.net/en/7", "no scheme", "", None, "://host/path", "http://u@x.example.com:80/de/", "http://É.example.NET/en/ß?", "http://net/", "http://net?x", "a://b://c/d",
]


def brute(url, rules=url_filter.RULES, blocked=url_filter.BLOCKED):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, *max(fit)[2:]
    return host, path, None, "block" if any(label in blocked for label in host.split(".")) else "allow"


def test_judges_as_brute_force(spark):
    rng = random.Random(2)
    urls = URLS + [f"http://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(['x', 'example', 'spam-farm'])}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/{i}" for i in range(200)]
    frame = spark.createDataFrame([(i // 2, u, "n", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string").repartition(3)
    got = url_filter.judge_urls(frame).collect()
    want = [(i // 2, *brute(u)) for i, u in enumerate(urls)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_collisions_are_told_apart(tmp_path):
    same = lambda key: len(key)
    keys = {"aa": 1, "ab": 2, "c": 3}
    (tmp_path / "d").write_bytes(url_filter.DigestArray.build(keys, same))
    array = url_filter.DigestArray(str(tmp_path / "d"))
    assert array.find(["ab", "aa", "zz", "c", "d", ""], same).tolist() == [2, 1, -1, 3, -1, -1]


def test_host_of_many_labels(spark):
    """200,000 labels: what is probed is linear."""
    urls = ["http://" + "a." * 200_000 + "example.net/en/x", "http://" + "spam-farm." * 20_000 + "q/", "http://" + "a." * 100_000 + "evil.com/", "http://..org/fr/", "http://.../"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    hosts = spark.createDataFrame([("evil.com",)], "host string")
    began = time.time()
    got = [(r.rule, r.verdict) for r in sorted(url_filter.judge_urls(frame, blocklist=hosts).collect())]
    assert got == [("example.net/en/", "allow"), (None, "block"), (None, "block"), ("org/fr/", "allow"), (None, "allow")]
    assert time.time() - began < 60


def test_no_rules_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "http://spam-farm.org/fr/")], "page_id long, url string")
    assert url_filter.judge_urls(frame, rules=[], blocked=[]).first().verdict == "allow"
    assert url_filter.judge_urls(frame.limit(0)).count() == 0


def test_blocklist_from_a_table(spark):
    hosts = spark.createDataFrame([("Bad.example.org", "x"), ("evil.com", "x"), ("evil.com", "y"), (None, "z"), ("", "z")], "host string, note string")
    urls = ["http://a.bad.example.org/x", "http://bad.example.org/fr/", "http://example.org/", "https://EVIL.com", "https://notevil.com/", "http://com/", None]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(frame, blocklist=hosts).collect()}
    assert [got[i] for i in range(7)] == ["block", "allow", "allow", "block", "allow", "allow", "allow"]
    with pytest.raises(ValueError, match="blocklist"):
        url_filter.judge_urls(frame, blocklist=hosts, most=1)


def test_very_long_urls(spark):
    urls = ["http://" + "a." * 3000 + "net/" + "p" * 200_000, "http://" + "x" * 100_000 + ".org/fr/" + "q" * 100_000, "http://example.com/de/" + "?" * 100_000]
    got = sorted(url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect())
    assert [tuple(r) for r in got] == [(i, *brute(u)) for i, u in enumerate(urls)]

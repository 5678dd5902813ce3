"""One scan, no shuffle and no Python for all tiers of a page; rows as they were found tier by tier."""

import random
import re
from urllib.parse import urljoin

from pyspark.sql import functions as F

from sigweave.functions import text, urls
from sigweave.sources import pages


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan(spark, tmp_path):
    spark.createDataFrame([("https://www.brand.com/", "<p>x</p>", 1)], "url string, html string, other int").write.parquet(f"{tmp_path}/pages")
    frame = spark.read.parquet(f"{tmp_path}/pages")
    plan = plan_of(pages.signals(frame, F.lit("2024-01-01").cast("timestamp")))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and not re.search("Python|Pandas|Arrow", plan)
    assert "other" not in plan
    feeds = spark.createDataFrame([("https://www.brand.com/f", "")], "feed_url string, feed_body string")
    plan = plan_of(pages.signals(frame, F.lit("2024-01-01").cast("timestamp"), feeds=feeds))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") <= 2 and not re.search("Python|Pandas|Arrow", plan)


def test_windows_overlap(spark):
    """A card's window goes on over the next card's tag, up to WINDOW characters; a pattern gives way after ENOUGH rows."""
    head = "A long headline, number {}"
    near = "".join(f'<li class="post">{"." * (10 if k else 0)}<h3>{head.format(k)}</h3><a href="/{k}">x</a></li>' for k in range(3))
    # the first card has no heading of its own within its tag, and takes the next one's
    far = '<div class="card"><i>no heading</i></div>' + " " * 1400 + '<div class="card"><h2>' + head.format(7) + '</h2><a href="/7">x</a></div>'
    cut = '<div class="card">' + " " * 1490 + "<h2>" + head.format(8) + '</h2><a href="/8">x</a></div>'
    many = "".join(f'<LI class="entry"><h3>{head.format(k)}</h3><a href="/{k}">x</a></LI>' for k in range(5)) + f'<a class="story" href="/9">{head.format(9)}</a>'
    few = "".join(f'<li class="entry"><h3>{head.format(k)}</h3><a href="/{k}">x</a></li>' for k in range(4)) + f'<a class="story" href="/9">{head.format(9)}</a>'
    nested = f'<a rel="x" href="/10">\n <div class="blog">{head.format(10)}</div></a>'
    frame = spark.createDataFrame([(str(i), h) for i, h in enumerate([near, far, cut, many, few, nested, None, ""])], "url string, html string")
    got = {}
    for r in pages.cards(frame).orderBy("url", "pos").collect():
        got.setdefault(r.url, []).append(r.link)
    assert got == {"0": ["/0", "/1", "/2"], "1": ["/7", "/7"], "3": [f"/{k}" for k in range(5)], "4": [f"/{k}" for k in (0, 1, 2, 3, 9)], "5": ["/10"]}


def test_each_row_is_a_page(spark):
    """The same page twice, a page of many rows, nulls."""
    one = '<article><h2>An article with a long title</h2><a href="/a">x</a></article>'
    rows = [("https://www.brand.com/", one), ("https://www.brand.com/", one), (None, one), ("https://www.brand.com/n", None), ("no url", one)]
    got = sorted(r.link for r in pages.signals(spark.createDataFrame(rows, "url string, html string"), F.current_timestamp()).collect())
    assert got == ["https://www.brand.com/a"] * 2
    many = "".join(f'<article><h2>An article with the number {k % 900}</h2><a href="/{k}">x</a></article>' for k in range(1000))
    got = pages.signals(spark.createDataFrame([("https://www.brand.com/", many)], "url string, html string"), F.current_timestamp(), take=2000).collect()
    assert [int(r.link.rsplit("/")[-1]) for r in got] == list(range(100, 900))


def test_resolve(spark):
    """Against the standard library's, whose answer for an address without a host is another."""
    rng = random.Random(1)
    bases = ["https://www.x.com/a/b/c.html?q=1#f", "https://www.x.com", "http://h.com/p/", "HTTP://h.com:80/p?x=/y/../z"]
    values = ["d.html", "../../../d", "//other.org/x", "?z=2", "#top", "http://y.com/a/../b", "mailto:a@b", "javascript:void(0)", "  /s p ", "", "..", ".", "/", "a/..", "e?x=../y", "../x?y=/../z#../w", "a:b", "HTTPS://Y.com"]
    values += ["".join(rng.choices(["a", "/", ".", "..", "/../", "./", "b.c", "?q", "#f"], k=6)) for _ in range(300)]
    values = [v for v in values if "//" not in re.split("[?#]", v)[0].replace("://", "").removeprefix("//o")]  # it drops empty segments
    frame = spark.createDataFrame([(v, b) for v in values for b in bases] + [(None, bases[0])], "v string, b string")
    for r in frame.withColumn("r", urls.resolve("v", "b")).collect():
        want = urljoin(r.b, r.v.strip()) if r.v and r.v.strip() else None
        want = want if want and want.lower().startswith(("http://", "https://")) else None
        tidy = lambda u: u and re.sub("^[A-Z]+:", lambda m: m[0].lower(), u).rstrip("?#")  # noqa: E731  it drops empty queries and fragments
        assert tidy(r.r) == tidy(want), (r.v, r.b)


def test_bytes_of_utf8_are_decoded_as_python_does(spark):
    """Random bytes, marks and names of other charsets in the same table."""
    rng = random.Random(6)
    bodies = [bytes(rng.choices([*b"ab <", 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0, 0xC0], k=rng.randint(0, 12))) for _ in range(400)] + [b"\xef\xbb\xbfmarked", b"", None]
    heads = [None, "text/html", "text/html; charset=UTF-8", "text/html; charset=utf8", "text/html; charset=latin1", "text/html; charset=nowhere"]
    rows = [(k, b, heads[k % len(heads)]) for k, b in enumerate(bodies)]
    rows += [(1000, '<meta charset="gbk">中文'.encode("gb18030"), None), (1001, '<meta charset="gbk">é'.encode(), "text/html; charset=utf-8"), (1002, b"x" * 2100 + b'<meta charset="gbk">', None)]
    got = {r.k: r.t for r in spark.createDataFrame(rows, "k int, b binary, h string").select("k", text.decode_body("b", "h").alias("t")).collect()}
    for k, b, h in rows:
        name = "gb18030" if k == 1000 else "cp1252" if h and "latin1" in h else "utf-8"
        assert got[k] == (None if b is None else b.decode(name, "replace").removeprefix("﻿")), (b, h)

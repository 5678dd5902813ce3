import json

import pytest
from pyspark.sql import functions as F

from sigweave.functions import text
from sigweave.operators import render
from sigweave.sources import markdown, pages

DAILY = """# H

> 2026-08-07

## 今日热点导览

- o1
- o2

## 今日头条

**h1**

b1（[S](https://a)）

## 技术工程解读

**h4**

b4（[S](https://d)）

**h2**

b2（[S2](https://b)）

## 骑行文化车展活动

**h9**

b9
"""


def item(i, category, relevant=True):
    return {"index": i, "heading": f"h{i}", "body": f"b{i}", "category": category, "relevant": relevant}


def daily(spark):
    said = {"headline": "H", "overview": [{"index": i, "text": f"o{i}"} for i in (1, 2, 3, 4)], "items": [item(1, "racing"), item(2, "tech"), item(3, "tech", False), item(4, "tech"), item(9, "culture")]}
    wrong = [said | {"headline": ""}, said | {"overview": []}, said | {"items": []}, said | {"items": [item(0, "tech")]}, said | {"items": [item(1, "boats")]}, {}]
    rows = [("2026-08-07", json.dumps(said)), ("2026-08-08", "{x"), ("2026-08-09", None), *[(f"2026-09-0{i}", json.dumps(w)) for i, w in enumerate(wrong)]]
    responses = spark.createDataFrame(rows, "day string, c string").select("day", render.checked_daily(F.col("c")).alias("r"))
    found = [(1, "S", "https://a", 9, True, True), (2, "S2", "https://b", 3, False, True), (3, "S", "https://c", 1, False, True), (4, "S", "https://d", 8, False, False)]
    return render.daily(responses, spark.createDataFrame([("2026-08-07", *f) for f in found], "day string, index int, source_name string, url string, score int, is_top boolean, is_leader boolean"))


def test_daily(spark):
    assert [tuple(r) for r in daily(spark).collect()] == [("2026-08-07", DAILY)]


def test_weekly_takes_the_last_item(spark):
    said = {"headline": "H", "briefing": "B", "items": [{"index": 1, "heading": "x", "body": "old"}, {"index": 1, "heading": "x1", "body": "new"}, {"index": 5, "heading": "x", "body": "y"}]}
    responses = spark.createDataFrame([("2026-07-27", json.dumps(said))], "monday string, c string").select("monday", render.checked_weekly(F.col("c")).alias("r"))
    rows = spark.createDataFrame([("2026-07-27", 1, "S", "https://a"), ("2026-07-27", 2, "S", "https://b")], "monday string, index int, source_name string, url string")
    assert render.weekly(responses, rows).first().markdown == "# H\n\n> 7月27日 – 8月2日（上周）\n\nB\n\n## 上周十大热点\n\n**1. x1**\n\nnew（[S](https://a)）\n"


def test_frames(spark):
    rows = spark.createDataFrame([("a RECALL", None, "racing"), ("a", "b", "tech"), ("a", "b", "other")], "t string, s string, c string")
    assert [r[0] for r in rows.select(render.frame_of(F.col("t"), F.col("s"), F.col("c"))).collect()] == ["利益相关", "技术拆解", ""]


def test_site(spark, tmp_path):
    (tmp_path / "2026-08-07.md").write_text(DAILY, encoding="utf-8")
    (tmp_path / "2026-08-07-子推送-ab12.md").write_text("# 子推送：Sub <x>\n\nbody\n", encoding="utf-8")
    (tmp_path / "2026-08-06-子推送-ab13.md").write_text("# No main file that day\n", encoding="utf-8")
    (tmp_path / "notes.md").write_text("x")
    files = markdown.files(spark, str(tmp_path))
    (day,) = markdown.days(markdown.entries(files)).collect()
    assert (day.date, day.title, day.item_count, day.highlights, [tuple(p) for p in day.pushes], day.header) == ("2026-08-07", "H", 4, ["o1", "o2"], [("2026-08-07-子推送-ab12.md", "Sub <x>")], "8月7日 · 周五")
    none = markdown.files(spark, str(tmp_path / "weekly"))
    assert none.isEmpty()
    assert markdown.write(markdown.site(files, none), str(tmp_path / "site")) == 5
    page = (tmp_path / "site/digests/2026-08-07.html").read_text(encoding="utf-8")
    assert '<p>b1（<a href="https://a">S</a>）</p>' in page and "<ul><li>o1</li><li>o2</li></ul>" in page
    assert "Sub &lt;x&gt;" in (tmp_path / "site/index.html").read_text(encoding="utf-8")


def test_page_fallbacks_and_feed(spark):
    html = [
        ("https://h.com/a", '<a href="/x" title="A titled link">t</a><a href="/x" title="second of it">t</a><a title="before it" href="/y">t</a>'),
        ("https://h.com/b", '<title>T &amp; x</title><meta property="og:type" content="article"><meta property="article:published_time" content="2026-08-01">'),
        ("https://brand.com/c", '<link rel="alternate" type="application/rss+xml" href="/feed"><article><h2><a href="/one">An article title of length</a></h2></article><article><h2><a href="https://sponsor.org/s">A foreign title of length</a></h2></article>'),
        ("https://h.com/d", '<article><h2><a href="/n">Latest Industry News</a></h2></article>'),
    ]
    frame, as_of = spark.createDataFrame(html, "url string, html string"), F.lit("2026-08-07").cast("timestamp")
    got = {(r.url[-1], r.link, r.title, r.tier, r.inferred) for r in pages.signals(frame, as_of).collect()}
    rest = {("a", "https://h.com/x", "A titled link", 3, True), ("b", "https://h.com/b", "T & x", 4, False)}
    assert got == rest | {("c", "https://brand.com/one", "An article title of length", 1, True)}
    for date, want in (("Fri, 07 Aug 2026 10:00:00 GMT", ("c", "https://brand.com/f1", "F1", 0, False)), ("soon", ("c", "https://brand.com/one", "An article title of length", 1, True))):
        feeds = spark.createDataFrame([("https://brand.com/feed", f"<item><title>F1</title><link>/f1</link><pubDate>{date}</pubDate></item>")], "feed_url string, feed_body string")
        assert {(r.url[-1], r.link, r.title, r.tier, r.inferred) for r in pages.signals(frame, as_of, feeds=feeds).collect()} == rest | {want}


def test_charset(spark):
    rows = [(bytearray("汽车".encode("gbk")), "text/html; charset=GB2312"), (bytearray(b'<meta charset="gbk">' + "汽车".encode("gbk")), None), (bytearray("é".encode()), "x; charset=nope"), (bytearray(b"\xff"), None), (None, None)]
    got = [r.t for r in spark.createDataFrame(rows, "b binary, h string").select(text.decode_body("b", "h").alias("t")).collect()]
    assert got == ["汽车", '<meta charset="gbk">汽车', "é", "\ufffd", None]


def test_site_is_written_by_executors(spark, tmp_path):
    """Old files are replaced, odd names kept, and a task that fails leaves the folder as it was."""
    folder = tmp_path / "site"
    rows = spark.createDataFrame([("index.html", "one\n"), ("digests/2024-01-01 a%b=c.html", "two\nlines\n\n"), ("digests/é.html", ""), ("x", None), ("x", "more"), (None, "no"), ("", "no")], "name string, content string")
    assert markdown.write(rows, str(folder)) == 4
    found = lambda: {str(f.relative_to(folder)): f.read_text() for f in folder.rglob("*") if f.is_file() and not f.name.endswith(".crc")}
    first = {"index.html": "one\n", "digests/2024-01-01 a%b=c.html": "two\nlines\n\n", "digests/é.html": "\n", "x": "more\n"}
    assert found() == first

    def fail(parts):
        for pdf in parts:
            yield pdf
            raise ValueError

    with pytest.raises(Exception, match="ValueError"):
        markdown.write(spark.createDataFrame([("index.html", "new"), ("y", "new")], "name string, content string").mapInPandas(fail, "name string, content string"), str(folder))
    assert found() == first and not list(folder.glob("_aside*"))
    assert markdown.write(spark.createDataFrame([("index.html", "new")], "name string, content string"), str(folder)) == 1 and found()["index.html"] == "new\n"
    assert markdown.write(rows.limit(0), str(tmp_path / "none")) == 0

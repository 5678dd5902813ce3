"""A run from sources to signals, state and report, with made replies."""

import pytest
from pyspark.sql import functions as F

from sigweave import schema
from sigweave.operators import dedup
from sigweave.plans import collect
from sigweave.sources import state
from sigweave.sources.fetch import Reply

SOURCES = f"{schema.SOURCE}, source_name string, homepage_url string"
PAGE = "<html>" + " " * 100 + '<article><h2>A first article of the page</h2><a href="/a?utm_source=x">x</a></article><article><h2>A second article of the page</h2><a href="/b/">x</a></article></html>'
LONG = "This paragraph holds forty characters, or more of them, and goes on."
FEED = "<rss><channel><title>t</title><item><title>Told by the feed {0}</title><link>/f/{0}</link><guid>g{0}</guid><pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate></item></channel></rss>"
CSV = "month,bidding_no,vehicle_class,quota,bids_success,bids_received,premium\n2024-01,1,Category D,1,1,2,900"
WEB = {
    "https://p.com/": PAGE, "https://p.com/a": f"<p>{LONG}</p>", "https://p.com/b": "<p>no</p>", "https://short.com/": "<p>x</p>", "https://r.com/rss": FEED.format(1), "https://r.com/": "<p>home</p>",
    "https://lost.com/": '<link rel="alternate" type="application/rss+xml" href="/other">', "https://lost.com/other": FEED.format(2), "https://c.com/csv": CSV,
    "https://fed.com/": "<html>" + " " * 100 + '<link type="application/rss+xml" href="/in"><article><h2>An article without a date</h2><a href="/x">x</a></article>', "https://fed.com/in": FEED.format(3),
}


def source(slug, adapter, url, home=None):
    return (slug, adapter, "en", "tech", url, 50, False, slug.title(), home or url)


def send():
    return [lambda url, headers, timeout: Reply(200, {}, [WEB[url].encode()]) if url in WEB else Reply(404)]


HOW = {"ways": send, "addresses": lambda name: ["93.184.216.34"], "sleep": lambda s: None, "tasks": 4}


def test_run(spark, tmp_path):
    sources = [
        source("page", "web-scraper", "https://p.com/"), source("short", "web-scraper", "https://short.com/"), source("gone", "web-scraper", "https://gone.com/"), source("rss", "rss", "https://r.com/rss", "https://r.com/"),
        source("lost", "rss", "https://lost.com/rss", "https://lost.com/"), source("bids", "lta-coe", "https://c.com/csv"), source("fed", "web-scraper", "https://fed.com/"), source("odd", "carrier-pigeon", "https://p.com/"),
    ]
    frame = spark.createDataFrame(sources, SOURCES)
    as_of = F.lit("2024-02-01 20:00:00").cast("timestamp")
    run = collect.run(frame, str(tmp_path), as_of, **HOW)
    report = {r.source_slug: (r.fetched, r.new, r.error) for r in run.report.collect()}
    assert report == {
        "page": (2, 2, None), "short": (0, 0, "the page is too short"), "gone": (0, 0, "permanent_http: HTTP 404"), "rss": (1, 1, None), "lost": (1, 1, None), "bids": (1, 1, None), "fed": (1, 1, None), "odd": (0, 0, "unknown adapter: carrier-pigeon"),
    }
    kept = spark.read.parquet(f"{tmp_path}/signals")
    got = {(r.source_slug, r.link): (r.title, r.summary) for r in kept.collect()}
    assert got["page", "https://p.com/a"] == ("A first article of the page", LONG) and got["page", "https://p.com/b"][1] == "A second article of the page x"
    assert got["lost", "https://lost.com/f/2"][0] == "Told by the feed 2" and ("fed", "https://fed.com/f/3") in got
    assert {str(r.day) for r in kept.collect()} == {"2024-02-02"}
    again = collect.run(frame, str(tmp_path), F.lit("2024-02-02 20:00:00").cast("timestamp"), **HOW)
    assert {r.source_slug: r.new for r in again.report.collect()} == dict.fromkeys(report, 0) and again.fresh.count() == 0
    assert spark.read.parquet(f"{tmp_path}/signals").count() == 6


def test_own_dimension(spark):
    rows = {r.source_slug: r for r in schema.sources(spark).collect()}
    assert len(rows) == 16 and rows["rideapart"].homepage_url == "https://www.rideapart.com/" and all(r.source_name and r.homepage_url for r in rows.values())


def test_state_by_day(spark, tmp_path):
    path = str(tmp_path / "state")
    keys = lambda *k: spark.createDataFrame([("s", x) for x in k], "source_slug string, dedup_key string")
    seen = lambda: sorted(r.dedup_key for r in state.load_days(spark, path).collect())
    files = lambda: {f for f in tmp_path.rglob("*.parquet")}
    assert seen() == []
    state.add_day(keys("a", "b"), path, "2024-01-01 10:00:00")
    state.add_day(keys("c"), path, "2024-01-01 20:00:00")
    state.add_day(keys(*map(str, range(500))), path, "2024-01-02 10:00:00")
    first = files()
    state.add_day(keys("d"), path, "2024-01-20 10:00:00")
    assert len(seen()) == 504 and first < files()
    # one new key writes one small part, and the parts before it stay as they are
    assert sum(f.stat().st_size for f in files() - first) < 5000

    def fail(parts):
        raise ValueError
        yield

    with pytest.raises(Exception, match="ValueError"):
        state.add_day(keys("e", "f").mapInPandas(fail, "source_slug string, dedup_key string"), path, "2024-01-20 11:00:00")
    assert len(seen()) == 504
    state.drop_days(spark, path, "2024-01-31 15:00:00")  # 30 days: the first of January until 15:00
    assert "a" not in seen() and "b" not in seen() and "c" in seen() and len(seen()) == 502
    state.drop_days(spark, path, "2024-01-15 00:00:00")  # an earlier clock brings nothing back
    assert len(seen()) == 502
    state.drop_days(spark, path, "2024-02-01 10:00:01")
    assert seen() == ["d"] and not list(tmp_path.rglob("day=2024-01-01"))


def test_state_by_day_forgets_as_the_rule_says(spark, tmp_path):
    """Against operators.dedup on a plain table, run by run."""
    path, plain = str(tmp_path / "state"), spark.createDataFrame([], state.STATE)
    for n, at in enumerate(["2024-01-01 08:00:00", "2024-01-20 08:00:00", "2024-01-31 07:59:59", "2024-01-31 08:00:01", "2024-02-19 08:00:00", "2024-03-30 00:00:00"]):
        rows = spark.createDataFrame([("s", f"k{(n * 3 + k) % 7}", k) for k in range(4)], "source_slug string, dedup_key string, seq int")
        mine = dedup.new_rows(rows, state.load_days(spark, path), ["seq"])
        got = sorted(r.dedup_key for r in mine.collect())
        assert got == sorted(r.dedup_key for r in dedup.new_rows(rows, plain, ["seq"]).collect())
        as_of = F.lit(at).cast("timestamp")
        plain = spark.createDataFrame(dedup.next_state(plain, dedup.new_rows(rows, plain, ["seq"]), as_of).collect(), state.STATE)
        state.add_day(spark.createDataFrame([("s", k) for k in got], "source_slug string, dedup_key string"), path, as_of)
        state.drop_days(spark, path, as_of)
        assert sorted(r.dedup_key for r in state.load_days(spark, path).collect()) == sorted(r.dedup_key for r in plain.collect())

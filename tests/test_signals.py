import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from sigweave import schema
from sigweave.functions import dates, scoring, text, urls
from sigweave.operators import cluster, dedup, score, select
from sigweave.sources import feeds, pages, registry


def value(spark, c, **row):
    types = {str: "string", int: "int", float: "double", bool: "boolean"}
    frame = spark.createDataFrame([tuple(row.values())] or [(1,)], ", ".join(f"{k} {types[type(v)]}" for k, v in row.items()) or "x int")
    return frame.select(c.alias("v")).first().v


def test_urls(spark):
    one = lambda u: value(spark, urls.canonical_url(F.col("u")), u=u)
    assert one("HTTPS://Ex.com:443/a/b/?utm_source=x&b=2&a=1#f") == "https://ex.com/a/b?a=1&b=2"
    assert one("ftp://x.y") is None and one("not a url") is None and one("https://h.com") == "https://h.com/"
    assert one("http://h.com:80/?b=2&a=2&b=1&REF=3") == "http://h.com/?a=2&b=2&b=1"
    assert value(spark, urls.core_label(F.col("h")), h="news.honda.com.my") == "honda"
    assert value(spark, urls.safe_url(F.col("u")), u="http://10.0.0.1/x") is False and value(spark, urls.safe_url(F.col("u")), u="http://example.com/") is True
    assert value(spark, urls.resolve("a", "b"), a="../x", b="https://h.com/y/z") == "https://h.com/x"


def test_text(spark):
    assert set(value(spark, text.title_tokens(F.col("t")), t="The New Honda CB-750 a")) == {"honda", "cb", "750"}
    assert value(spark, text.fingerprint(F.col("t")), t="新honda车") == "honda" and value(spark, text.fingerprint(F.col("t")), t="hondata") is None
    assert value(spark, text.decode_entities(F.col("t")), t="&#8217;&#0039;&amp;lt;") == "’'<"
    assert value(spark, text.short_hash(F.col("t")), t="abc") == "17862"
    assert value(spark, text.strip_html(F.col("t")), t="<p>a&nbsp;b</p> c ") == "a b c"
    assert value(spark, text.jaccard(F.split("a", " "), F.array().cast("array<string>")), a="x y") == 0


def test_dates(spark):
    assert str(value(spark, dates.monday_of(F.col("d").cast("date")), d="2026-08-02")) == "2026-07-27"
    assert str(value(spark, dates.business_day(F.col("d").cast("timestamp")), d="2026-08-06 18:00:00")) == "2026-08-07"
    for t in ("2026年8月7日", "Fri, 07 Aug 2026 00:00:00 GMT", "August 7, 2026", "7 August 2026", "2026-08-07", "2026-08-07T00:00:00.000Z", "2026-08-07T08:00:00+08:00"):
        assert str(value(spark, dates.parse_date(F.col("t")), t=t)) == "2026-08-07 00:00:00", t
    assert value(spark, dates.parse_date(F.col("t")), t="soon") is None


def test_scores(spark):
    def conf(a, p, n):
        return value(spark, scoring.confidence(F.col("a"), F.col("p"), F.col("n")), a=a, p=p, n=n)

    assert conf(82, False, 1) == 49 and conf(95, True, 4) == 100
    assert value(spark, scoring.heat(F.col("k"), F.lit(1), F.lit("x"), F.lit(1.0), F.lit(False)), k="other") == 40
    assert value(spark, scoring.heat(F.col("k"), F.lit(9), F.lit("Record recall, MÁRQUEZ"), F.lit(24.0), F.lit(True)), k="tech") == 100
    assert value(spark, scoring.keyword_hits(F.col("k")), k="recorded RECALL 首发") == 3


def brute_first_fit(n, edges):
    groups = []
    for i in range(n):
        for g in groups:
            if any((j, i) in edges for j in g):
                g.append(i)
                break
        else:
            groups.append([i])
    return {i: g[0] for g in groups for i in g}


@pytest.mark.parametrize("seed", range(4))
def test_first_fit(spark, seed):
    rng = random.Random(seed)
    n = 40
    edges = {(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.04} | {(0, 2), (1, 2)}
    got = {r.seq: r.cluster_id for r in cluster.first_fit(spark.createDataFrame(list(edges), "a long, b long")).collect()}
    want = brute_first_fit(n, edges)
    assert all(got.get(i, i) == want[i] for i in range(n))


def test_links(spark):
    hour = 3600
    rows = [
        (0, 0, "racing", "honda", ["a", "b"]), (1, 504 * hour, "racing", "honda", ["c"]), (2, 504 * hour + 1, "racing", "honda", ["d"]), (3, 0, "tech", "honda", ["a", "b"]),
        (4, 96 * hour, "x", None, ["a", "b", "z"]), (5, 96 * hour + 1, "x", None, ["a", "b"]), (6, None, "x", None, ["a", "b"]), (7, 5, "x", None, []),
    ]
    frame = spark.createDataFrame(rows, "seq long, s long, category string, fp string, tokens array<string>").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r.a, r.b) for r in cluster.links(frame).collect()}
    assert got == {(0, 1), (1, 2), (0, 4), (3, 4), (4, 5)}


def test_state_keeps_and_prunes(spark):
    state = spark.createDataFrame([("s", "k", "2026-01-01"), ("s", "old", "2025-12-31 23:59:59")], "source_slug string, dedup_key string, at string").select("source_slug", "dedup_key", F.col("at").cast("timestamp").alias("first_seen"))
    rows = spark.createDataFrame([("s", "k", 1), ("s", "old", 2), ("s", "n", 3), ("s", "n", 4), ("t", "k", 5), ("s", None, 6)], "source_slug string, dedup_key string, seq int")
    fresh = dedup.new_rows(rows, state, ["seq"])
    assert sorted(r.seq for r in fresh.collect()) == [3, 5]
    after = dedup.next_state(state, fresh, F.lit("2026-01-31").cast("timestamp"))
    assert sorted((r.source_slug, r.dedup_key) for r in after.collect()) == [("s", "k"), ("s", "n"), ("t", "k")]


def test_scored_day(spark):
    def signal(seq, slug, title, category, at):
        return (seq, slug, title, "A summary that is long enough to be pushed on its own, by all means.", category, at)

    rows = [signal(0, "motogp-news", "MotoGP calendar announced", "racing", "2026-08-07T00:00:00.000Z"), signal(1, "visordown", "New helmet seen", "tech", "2026-08-07T00:00:00.000Z")]
    old = [signal(10, "worldsbk-news", "MotoGP season postponed", "racing", "2026-08-05T00:00:00.000Z")]
    make = lambda r: spark.createDataFrame(r, "seq long, sourceSlug string, title string, summary string, category string, publishedAt string").withColumn("rawMeta", F.struct(F.lit(False).alias("dateInferred")))
    out = {r.seq: r for r in score.scored(make(rows), F.lit("2026-08-07 01:00:00").cast("timestamp"), make(old)).collect()}
    assert (out[0].cluster_size, out[0].confidence, out[0].heat) == (2, 87, 100) and (out[1].cluster_size, out[1].confidence, out[1].heat) == (1, 45, 60)
    frame = score.scored(make(rows), F.lit("2026-08-07 01:00:00").cast("timestamp"))
    assert [r.seq for r in select.top_leaders(frame, "category", "score").collect()] == [0, 1]
    assert [r.seq for r in select.candidates(frame).collect()] == [0]


def test_page_and_feed(spark):
    html = """<html><script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"A graph headline here","url":"/g","datePublished":"2026-08-01"},{"@type":"Person","name":"No"}]}</script>
    <script type="application/ld+json">{broken</script><div class="items-center"><a href="/no">not a card at all</a></div>
    <article><h2><a href="/one">An article title of length</a></h2><time datetime="2026-08-02">x</time><p>Too short.</p><p>This paragraph holds forty characters, or more of them.</p></article>
    <div class="card"><h3>Short title</h3><a href="/s">x</a></div><div class="card"><h3>Fifteen letters</h3><a href="/f">x</a></div></html>"""
    as_of = F.lit("2026-08-07").cast("timestamp")
    frame = spark.createDataFrame([("https://h.com/news", html), ("https://h.com/none", None)], "url string, html string")
    got = {r.link: r for r in registry.adapter("web-scraper")(frame, as_of).collect()}
    assert got.keys() == {"https://h.com/g", "https://h.com/one", "https://h.com/f"}
    assert got["https://h.com/g"].title == "A graph headline here" and not got["https://h.com/g"].inferred and got["https://h.com/f"].inferred
    assert frame.select(pages.excerpt(F.col("html")).alias("e")).first().e == "This paragraph holds forty characters, or more of them."
    feed = """<rss><channel><item><title>T &amp; x</title><link>/a</link><description>&lt;b&gt;D&lt;/b&gt;</description><pubDate>Fri, 07 Aug 2026 10:00:00 GMT</pubDate><guid isPermaLink="false">g1</guid></item><item><title></title><link>/b</link></item></channel></rss>"""
    rows = feeds.signals(spark.createDataFrame([("https://h.com/rss", feed)], "url string, body string"), as_of).collect()
    assert [(r.external_id, r.link, r.title, r.summary, r.inferred) for r in rows] == [("g1", "https://h.com/a", "T & x", "D", False)]
    with pytest.raises(ValueError):
        registry.adapter("other")


def test_entry():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(schema.SOURCES) == 16

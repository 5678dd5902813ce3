import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigweave import schema
from sigweave.functions import dates, text
from sigweave.operators import score, tables
from sigweave.plans import flows
from sigweave.sources import feeds, pages, registry, snapshots
from sigweave.streaming import corroboration, first_seen

RSS = "<rss><channel><item><title>A title of {0}</title><link>/i/{0}</link></item></channel></rss>"


def as_of():
    return F.lit("2024-02-01 03:00:00").cast("timestamp")


def test_every_source_has_an_adapter():
    for s in schema.SOURCES:
        assert registry.adapter(s[1])
    with pytest.raises(ValueError, match="unknown"):
        registry.adapter("none")


def test_feeds_fall_back_to_what_the_homepage_names(spark):
    sources = spark.createDataFrame(
        [("own", "https://a/rss", "https://a/"), ("lost", "https://b/rss", "https://b/"), ("same", "https://c/", "https://c/"), ("loop", "https://d/rss", "https://d/"), ("none", "https://e/rss", "https://e/")],
        "source_slug string, url string, homepage_url string",
    )
    fetched = spark.createDataFrame([("https://a/rss", RSS.format("a")), ("https://b/rss", None), ("https://b/feed", RSS.format("b")), ("https://c/", None)], "url string, body string")
    link = "<link rel='alternate' type='application/atom+xml' href='{}'>"
    homepages = spark.createDataFrame([("https://a/", link.format("/other")), ("https://b/", link.format("/feed")), ("https://d/", link.format("/rss")), ("https://e/", "<p>no feed")], "url string, html string")
    got = feeds.with_fallback(sources, fetched, homepages)
    assert {(r.source_slug, r.url) for r in got.collect()} == {("own", "https://a/rss"), ("lost", "https://b/feed")}
    rows = {r.title: r.link for r in feeds.signals(got.select("url", "body"), as_of()).collect()}
    assert rows == {"A title of a": "https://a/i/a", "A title of b": "https://b/i/b"}


def test_bidding_rounds(spark):
    body = "month,bidding_no,vehicle_class,quota,bids_success,bids_received,premium\n2024-01,1,Category D,5,4,9,900\n2024-01,2,Category A,5,4,9,1\n"
    got = feeds.bid_signals(spark.createDataFrame([("u", body), ("none", "month,vehicle_class\n"), ("empty", "")], "url string, body string"), as_of()).collect()
    assert [(r.external_id, r.published) for r in got] == [("lta-coe-2024-01-1", dt.datetime(2024, 1, 1))]


def test_headings_dates_and_texts(spark):
    cases = [
        ('<a href="x">y</a><div class="a headline b">In a <b>class</b></div>', "In a class", None, None),
        ("  Leading text &amp; more <b>tag</b> 2024-05-06", "Leading text more", None, "2024-05-06"),
        ('<h2> </h2><h3>Third</h3><h1></h1><a class="title" href="/t">no</a>', "", None, None),
        ("<p></p>", None, None, None),
        ("<P CLASS='x'>x</P><span class=\"title\" href='n'>Single 3 May 2024</span><meta content='2024-01-02' itemprop='datePublished'>", "Single 3 May 2024", None, "2024-01-02"),
        ('<img src="/2019-01-01.png">May 3, 2024 and 2024年5月6日', None, None, "May 3, 2024"),
    ]
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, html string")
    got = sorted(frame.select("i", pages.heading(F.col("html")).alias("h"), pages.published(F.col("html")).alias("d")).collect())
    assert [(r.h.title, r.h.href, r.d) for r in got] == [c[1:] for c in cases]
    shown = spark.createDataFrame([("a<script>b</SCRIPT>c <style>d</style>e<i>f</i><img src=",)], "html string").select(pages.text_content(F.col("html")).alias("t"))
    assert shown.first().t == "ac e f"
    assert spark.createDataFrame([("a&Uuml;b&nbsp;c",)], "x string").select(text.strip_html(F.col("x")).alias("t")).first().t == "a&Uuml;b c"


def test_cards_stop_after_a_pattern_with_enough(spark):
    card = lambda tag, i: f'<{tag} class="card"><h2>A heading of sign {tag} {i}</h2><a href="/{tag}/{i}">x</a></{tag}>' + " " * 1500
    html = [("https://a.com/", "".join(card("li", i) for i in range(3)) + "".join(card("div", i) for i in range(2))), ("https://b.com/", "".join(card("li", i) for i in range(5)) + card("div", 9))]
    got = pages.cards(spark.createDataFrame(html, "url string, html string")).groupBy("url").agg(F.sort_array(F.collect_list("link")).alias("links")).collect()
    assert {r.url: len(r.links) for r in got} == {"https://a.com/": 5, "https://b.com/": 5}


def signal(i, title, slug, day, category="racing"):
    return {"externalId": f"x{i}", "url": f"https://x/{i}", "title": title, "summary": f"Summary of {title}", "publishedAt": f"{day}T00:00:00Z", "category": category, "rawMeta": {"dateInferred": False}, "sourceSlug": slug, "sourceName": slug.upper()}


def test_week_from_signals_to_document(spark, tmp_path):
    rows = [signal(0, "Honda wins the long race of the year", "rideapart", "2024-01-22"), signal(1, "Honda takes it", "visordown", "2024-01-23"), signal(2, "A quiet day of nothing much", "eicma", "2024-01-24", "culture")]
    for day, part in (("2024-01-22", rows[:1]), ("2024-01-23", rows[1:])):
        pd.Series([{"collectedAt": f"{day}T03:00:00Z", "signals": part}]).to_json(tmp_path / f"{day}.json", orient="records", lines=True)
    signals = snapshots.read(spark, str(tmp_path), ["2024-01-22", "2024-01-23", "2024-01-25"])
    best = tables.stored(flows.week(signals, as_of()), "best")
    got = best.orderBy("index").collect()
    assert len(got) == 2 and got[0].cluster_size == 2 and [r["index"] for r in got] == [1, 2]
    whole = {r.seq: r.score for r in score.scored(signals, as_of()).collect()}
    assert got[0].score == max(whole.values())
    prompt = flows.week_prompt(best, F.lit("2024-01-22")).first().text
    assert prompt.startswith("上周（2024-01-22 至 2024-01-28）选出了 2 条代表性热点，请据此生成周报：\n\n1. 【racing】Honda") and "\n\n2. 【culture】A quiet day" in prompt
    response = '{"headline":"H","briefing":"B","items":[{"index":2,"heading":"h2","body":"b2"},{"index":1,"heading":"h1","body":"b1"}]}'
    document = flows.week_document(best, F.lit(response), F.lit("2024-01-22")).first().markdown
    assert document.index("1. h1") < document.index("2. h2") and "https://x/2" in document
    assert flows.week_document(best, F.lit('{"headline":"H"}'), F.lit("2024-01-22")).count() == 0


def test_push_prompt(spark):
    row = spark.createDataFrame([("T", "tech", "S", "about")], "title string, category string, source_name string, summary string")
    assert flows.push_prompt(row).first().text == "新闻标题：T\n类别：tech\n来源：S\n摘要：about"


def test_snapshot_table_grows_by_day(spark, tmp_path):
    path = str(tmp_path / "table")
    for day, n in (("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-02", 3)):
        snapshots.append(spark.range(n).withColumn("day", F.lit(day)), path)
    assert {str(r.day): r["count"] for r in spark.read.parquet(path).groupBy("day").count().collect()} == {"2024-01-01": 2, "2024-01-02": 4}


def test_dates_and_slugs(spark):
    c = spark.createDataFrame([("2024-03",), ("March",)], "m string").select(dates.month_start(F.col("m"), as_of()).alias("d"))
    assert [r.d for r in c.collect()] == [dt.datetime(2024, 3, 1), dt.datetime(2024, 2, 1, 3)]
    s = spark.createDataFrame([("Ünï Code--x",), ("!!",)], "x string").select(text.slugify(F.col("x")).alias("s")).collect()
    assert s[0].s == "u-ni-code-x" and s[1].s.startswith("item-")


def batches(spark, tmp_path, parts, ddl, made):
    """What a stream of the parts, a file each, puts out in all."""
    folder = tmp_path / "in"
    for i, part in enumerate(parts):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(str(folder / f"{i}"))
    stream = spark.readStream.schema(ddl).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = made(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_stream_keeps_the_first_of_a_key(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d)
    parts = [[("a", "k", at(1)), ("a", "k", at(1))], [("a", "k", at(2)), ("b", "k", at(2))], [("b", "k", at(3)), ("a", "n", at(3))]]
    got = batches(spark, tmp_path, parts, "source_slug string, dedup_key string, ts timestamp", lambda s: first_seen.first_in_window(s, ["source_slug", "dedup_key"], "ts"))
    assert sorted((r.source_slug, r.dedup_key) for r in got.collect()) == [("a", "k"), ("a", "n"), ("b", "k")]


def test_stream_counts_sources_of_an_event(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d, 5)
    rows = [("honda", "racing", "a", at(1)), ("honda", "racing", "b", at(3)), ("honda", "racing", "b", at(3)), ("honda", "tech", "c", at(3)), (None, "racing", "d", at(3)), ("honda", "racing", "e", at(9))]
    ddl = "fp string, category string, source_slug string, ts timestamp"
    want = {(str(r.from_ts), r.category): r.sources for r in corroboration.corroborated(spark.createDataFrame(rows, ddl)).collect()}
    assert want["2024-01-01 00:00:00", "racing"] == 2 and want["2024-01-02 00:00:00", "racing"] == 1 and want["2024-01-01 00:00:00", "tech"] == 1
    got = batches(spark, tmp_path, [rows[:2], rows[2:], [("ktm", "racing", "a", at(28))]], ddl, corroboration.corroborated)
    got = {(str(r.from_ts), r.category): r.sources for r in got.collect()}
    assert got == want

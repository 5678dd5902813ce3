from pyspark.sql import functions as F

from sigweave.plans import flows


def test_enriched(spark):
    long_ = "This paragraph holds forty characters, or more of them."
    rows = spark.createDataFrame([(1, "u", "web-scraper", "short"), (2, "u", "rss", "short"), (3, "u", "web-scraper", long_ + " and more"), (4, "v", "web-scraper", None), (5, None, "web-scraper", "s")], "seq int, link string, adapter string, summary string")
    fetched = spark.createDataFrame([("u", f"<p>{long_}</p>"), ("u", "<p>no</p>"), ("u", f"<p>{long_[:42]}</p>"), ("v", f"<p>{long_}</p>"), ("w", None)], "url string, html string")
    got = {r.seq: r.summary for r in flows.enriched(rows, fetched).collect()}
    assert got == {1: long_, 2: "short", 3: long_ + " and more", 4: long_, 5: "s"}


def test_collected(spark):
    state = spark.createDataFrame([("s", "https://h.com/a"), ("s", "id1")], "source_slug string, dedup_key string").withColumn("first_seen", F.lit("2026-01-30").cast("timestamp"))
    rows = [("s", None, "https://h.com/a/?utm_source=x", "t", 0), ("s", "id1", "https://h.com/b", "t", 1), ("s", "", "https://h.com/c", "t", 2), ("s", None, "https://h.com/c#x", "t", 3), ("t", "id1", None, None, 4), ("s", None, None, "", 5)]
    fresh, after = flows.collected(spark.createDataFrame(rows, "source_slug string, external_id string, link string, title string, seq int"), state, F.lit("2026-01-31").cast("timestamp"))
    assert sorted(r.seq for r in fresh.collect()) == [2, 4]
    assert {(r.source_slug, r.dedup_key) for r in after.collect()} == {("s", "https://h.com/a"), ("s", "id1"), ("s", "https://h.com/c"), ("t", "id1")}


def test_day(spark):
    long_ = "A summary that is long enough to be pushed on its own, by all means."
    rows = [(7, "motogp-news", "MotoGP", "MotoGP recall announced", "racing", "2026-08-07T00:00:00.000Z", "x"), (9, "visordown", "VD", "New helmet seen", "tech", "2026-08-07T00:00:00.000Z", "y"), (12, "visordown", "VD", "Other gloves seen", "tech", "2026-08-01T00:00:00.000Z", "z")]
    signals = spark.createDataFrame(rows, "seq long, sourceSlug string, sourceName string, title string, category string, publishedAt string, externalId string")
    signals = signals.withColumn("summary", F.lit(long_)).withColumn("day", F.lit("2026-08-07")).withColumn("rawMeta", F.struct(F.lit(False).alias("dateInferred")))
    out = flows.day(signals, F.lit("2026-08-07 01:00:00").cast("timestamp"))
    assert sorted((r.seq, r["index"], r.is_leader, r.is_top) for r in out.collect()) == [(7, 1, True, True), (9, 2, True, True), (12, 3, False, False)]
    lines = flows.day_prompt(out).first().text.split("\n\n")
    assert lines[0] == f"1. 【今日头条】【racing】MotoGP recall announced\n   来源：MotoGP　时间：2026-08-07\n   摘要：{long_}" and lines[2].startswith("3. 【tech】Other")
    (push,) = flows.pushes(out).collect()
    assert (push.seq, push.frame, push.filename) == (7, "利益相关", "2026-08-07-子推送-78.md")

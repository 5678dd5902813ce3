"""One collecting run: sources to new signals, the next state and a report.

Every url is fetched once a round and stored, so that no later step asks again: the sources' own addresses with the
homepages of feeds; then the feeds that those pages name; then the articles of new rows. A source whose fetch fails, or
whose page is too short to be one, is in the report with its error; the others go on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.functions import dates, text, urls
from sigweave.operators import dedup
from sigweave.operators.tables import stored
from sigweave.sources import feeds, fetch, pages, registry, snapshots, state

from . import flows

#: Characters that a page has at least.
LEAST = 100


@dataclass
class Run:
    fresh: DataFrame
    report: DataFrame


def _bodies(rows: DataFrame, tag: str, how: dict) -> DataFrame:
    """url, body (text; null where the fetch failed), status, error of the urls of rows, stored."""
    got = fetch.fetched(rows.select("url"), **how)
    error = F.concat_ws(": ", "kind", "error")
    return stored(got.select("url", text.decode_body("body", "content_type").alias("body"), "status", F.when(F.col("kind").isNotNull(), error).alias("error")), tag)


def collected(sources: DataFrame, as_of: Column, known: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """Rows of all sources (source_slug, source_name, adapter, category, language, external_id, link, title, summary,
    published, inferred, seq) and errors (source_slug, error). sources: as schema.sources(); known: the state; how: of
    fetch.fetched."""
    rss = F.col("adapter") == "rss"
    first = _bodies(sources.select("url").union(sources.where(rss).select("homepage_url")), "sources", how)
    own = stored(sources.join(first, "url", "left"), "own")
    short = (F.col("adapter") == "web-scraper") & (F.col("status") != 304) & (F.length("body") < LEAST)
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(short, F.lit("the page is too short")).when(~F.col("adapter").isin(list(registry.ADAPTERS)), F.concat(F.lit("unknown adapter: "), "adapter"))
    own = own.withColumn("error", error)
    homes = first.select("url", F.col("body").alias("html")).where("html is not null")
    named = feeds.discovered(homes.join(sources.where(rss).select(F.col("homepage_url").alias("url")).distinct(), "url", "left_semi"))
    scraped = own.where("adapter = 'web-scraper' and error is null and status <> 304").select("url", F.col("body").alias("html")).dropDuplicates(["url"])
    inner = scraped.select(urls.resolve(pages.feed_link(F.col("html")), F.col("url")).alias("url")).where("url is not null")
    more = _bodies(named.select(F.col("feed_url").alias("url")).union(inner).distinct(), "feeds", how)
    every = first.select("url", "body").union(more.select("url", "body"))
    fed = feeds.with_fallback(sources.where(rss), every, homes)
    in_page = more.where("body is not null").select(F.col("url").alias("feed_url"), F.col("body").alias("feed_body"))
    names = ["source_slug", "external_id", "link", "title", "summary", "published", "inferred", "pos"]
    of = lambda rows, kind: rows.join(sources.where(F.col("adapter") == kind).select("source_slug", "url"), "url").withColumn("pos", F.col("pos").cast("long"))
    from_pages = of(pages.signals(scraped, as_of, feeds=in_page).withColumnRenamed("url", "page").withColumn("url", F.col("page")), "web-scraper").withColumn("external_id", F.lit(None).cast("string"))
    # a feed found by a homepage stands for the source whose own address failed
    from_feeds = feeds.signals(fed.select("url", "body").dropDuplicates(["url"]), as_of).join(fed.select("source_slug", "url"), "url").withColumn("pos", F.col("pos").cast("long"))
    bids = own.where("adapter = 'lta-coe' and error is null").select("url", "body").dropDuplicates(["url"])
    rows = from_pages.select(names).unionByName(from_feeds.select(names)).unionByName(of(feeds.bid_signals(bids, as_of), "lta-coe").select(names))
    rows = rows.join(sources.select("source_slug", "source_name", "adapter", "category", "language"), "source_slug")
    place = F.xxhash64("source_slug").bitwiseAND(F.lit(0x7FFFFFFF)) * F.lit(1 << 32) + F.col("pos")  # a source's rows in their order
    saved = fed.select("source_slug").distinct()
    errors = own.where("error is not null").select("source_slug", "error").join(saved, "source_slug", "left_anti")
    return stored(rows.withColumn("seq", place).drop("pos"), "collected"), errors


def run(sources: DataFrame, folder: str, as_of: Column, **how) -> Run:
    """Collects, adds the new signals to folder/signals (a table by day), their keys to folder/state, and reports
    source_slug, source_name, fetched, new, error. The signals are written before the state: a run that ends between the
    two finds the same rows new again, and none is lost."""
    spark = sources.sparkSession
    known = state.load_days(spark, f"{folder}/state")
    rows, errors = collected(sources, as_of, known, **how)
    fresh, _ = flows.collected(rows, known, as_of)
    fresh = stored(fresh, "fresh")
    articles = _bodies(fresh.where("adapter = 'web-scraper'").select(F.col("link").alias("url")), "articles", how)
    fresh = stored(flows.enriched(fresh, articles.select("url", F.col("body").alias("html"))), "enriched")
    snapshots.append(fresh.withColumn("day", dates.business_day(as_of)), f"{folder}/signals")
    state.add_day(fresh, f"{folder}/state", as_of)
    state.drop_days(spark, f"{folder}/state", as_of)
    told = dedup.run_report(rows, fresh, errors)
    report = sources.select("source_slug", "source_name").join(told, "source_slug", "left")
    report = report.select("source_slug", "source_name", F.coalesce("fetched", F.lit(0)).alias("fetched"), F.coalesce("new", F.lit(0)).alias("new"), "error")
    return Run(fresh, report)

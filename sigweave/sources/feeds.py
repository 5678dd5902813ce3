"""RSS and Atom feeds (feed url, body), and bidding rounds from CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigweave.functions import dates, text, urls

_TEXTS = ("title", "description", "summary", "content", "pubDate", "published", "updated", "id")
_FIELDS = dict.fromkeys(_TEXTS, "string") | {"link": "array<struct<_VALUE: string, _href: string, _rel: string>>", "guid": "struct<_VALUE: string>"}
ITEM = ", ".join(f"{k} {v}" for k, v in _FIELDS.items())
TAKE = 50


def link_of(links: Column) -> Column:
    """The first alternate or unmarked link, else the first: its href, else its text."""
    plain = F.filter(links, lambda x: x["_rel"].isNull() | x["_rel"].isin("", "alternate"))
    chosen = F.coalesce(F.try_element_at(plain, F.lit(1)), F.try_element_at(links, F.lit(1)))
    return text.first_filled(chosen["_href"], chosen["_VALUE"])


#: A feed's document by its root: entries are those of rss.channel, else those of feed.
_ITEMS = "array<struct<" + ", ".join(f"{k}: {v}" for k, v in _FIELDS.items()) + ">>"
FEED = f"channel struct<item: {_ITEMS}>, entry {_ITEMS}, broken string"


def root_of(body: Column) -> Column:
    """The name of a document's first element."""
    return F.regexp_extract(body, r"^[\s\ufeff]*(?:(?:<\?[\s\S]*?\?>|<!--[\s\S]*?-->|<![A-Za-z][^>\[]*(?:\[[^\]]*\][^>]*)?>)\s*)*<([A-Za-z_][\w:.-]*)", 1)


def items(feeds: DataFrame) -> DataFrame:
    """url, pos and the item of every entry of the feeds' bodies. A body that is no well-formed document, as those with
    bare ampersands or entities of HTML, is read entry by entry."""
    whole = F.from_xml(F.regexp_replace("body", r"^[\s\ufeff]+", ""), FEED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    rows = feeds.select("url", "body", root_of(F.col("body")).alias("root"), whole.alias("whole"))
    rows = rows.withColumn("listed", F.when(F.col("root") == "rss", F.col("whole.channel.item")).when(F.col("root") == "feed", F.col("whole.entry")))
    broken = F.col("whole.broken").isNotNull()
    raw = F.when(broken, F.regexp_extract_all("body", F.lit(r"(?is)(<(item|entry)[ >].*?</\2>)"), F.lit(1)))
    found = rows.where(~broken).select("url", F.posexplode("listed").alias("pos", "item"))
    torn = rows.where(broken).select("url", F.posexplode(raw).alias("pos", "xml")).select("url", "pos", F.from_xml("xml", ITEM, {"mode": "PERMISSIVE"}).alias("item"))
    return found.unionByName(torn)


def signals(feeds: DataFrame, as_of: Column, take: int = TAKE) -> DataFrame:
    rows = items(feeds).withColumn("title", text.strip_tags(F.col("item.title"))).withColumn("link", urls.resolve(link_of(F.col("item.link")), F.col("url")))
    summary = text.first_filled(F.col("item.description"), F.col("item.summary"), F.col("item.content"), F.col("item.title"))
    date = text.first_filled(F.col("item.pubDate"), F.col("item.published"), F.col("item.updated"))
    rows = rows.withColumn("summary", F.substring(text.strip_tags(summary), 1, 8000)).withColumn("when", dates.dated(date, as_of))
    rows = rows.withColumn("external_id", text.first_filled(F.col("item.guid._VALUE"), F.col("item.id"), F.col("link")))
    w = Window.partitionBy("url").orderBy("pos")
    rows = rows.withColumn("nth", F.row_number().over(w)).where((F.col("nth") <= take) & (F.coalesce("title", F.lit("")) != "") & F.col("link").isNotNull())
    return rows.select("url", "pos", "external_id", "link", "title", "summary", "when.published", "when.inferred")


# The page of the bidding dataset, and the class whose rounds are told.
DATASET, CLASS, ROUNDS = "https://data.gov.sg/datasets/d_69b3380ad7e51aff3a7dcc84eba52b8a/view", "Category D", 2


def bid_rounds(bodies: DataFrame, vehicle_class: str = CLASS) -> DataFrame:
    """url, pos, month, bidding_no and the numbers of each round of the class. bodies: url, body, a CSV text each whose
    first line names the columns, in any order."""
    lines = bodies.select("url", F.split(text.trim_ws(F.col("body")), r"\r?\n").alias("lines"))
    names = F.split(F.col("lines")[0], ",")
    rows = lines.select("url", names.alias("names"), F.posexplode(F.slice("lines", F.lit(2), F.size("lines"))).alias("pos", "line")).withColumn("cells", F.split("line", ","))
    cell = lambda n: F.try_element_at("cells", F.nullif(F.array_position("names", n), F.lit(0)).cast("int"))
    numbers = [cell(n).try_cast("double").alias(n) for n in ("quota", "bids_success", "bids_received", "premium")]
    return rows.where(cell("vehicle_class") == vehicle_class).select("url", "pos", F.coalesce(cell("month"), F.lit("")).alias("month"), F.coalesce(cell("bidding_no"), F.lit("")).alias("bidding_no"), *numbers)


def bid_signals(bodies: DataFrame, as_of: Column, rounds: int = ROUNDS) -> DataFrame:
    """One row a body: its last rounds, told in order."""
    w = Window.partitionBy("url").orderBy(F.col("pos").desc())
    last = bid_rounds(bodies).withColumn("back", F.row_number().over(w)).where(F.col("back") <= rounds)
    whole = lambda c: F.col(c).cast("decimal(20,0)").cast("string")
    price = F.concat(F.lit("S$"), F.format_number("premium", 0))
    part = F.concat("month", F.lit(" 第"), "bidding_no", F.lit("轮：中标价 "), price, F.lit("（配额 "), whole("quota"), F.lit("，收到投标 "), whole("bids_received"), F.lit(" 份，中标 "), whole("bids_success"), F.lit(" 份）"))
    title = F.concat(F.lit("新加坡 COE Category D（摩托车）最新中标价："), price, F.lit("（"), "month", F.lit(" 第"), "bidding_no", F.lit("轮）"))
    told = last.groupBy("url").agg(F.max_by(F.struct("month", "bidding_no", title.alias("title")), "pos").alias("last"), F.sort_array(F.collect_list(F.struct("pos", part.alias("part")))).alias("parts"))
    key = F.concat(F.lit("lta-coe-"), "last.month", F.lit("-"), "last.bidding_no")
    when = dates.month_start(F.col("last.month"), as_of)
    return told.select("url", F.lit(0).alias("pos"), key.alias("external_id"), F.lit(DATASET).alias("link"), "last.title", F.array_join(F.transform("parts", lambda p: p["part"]), "；").alias("summary"), when.alias("published"), F.lit(False).alias("inferred"))


def discovered(homepages: DataFrame) -> DataFrame:
    """url, feed_url: the first feed that a page (url, html) names as its alternate; pages that name none are left out."""
    tags = F.filter(F.regexp_extract_all("html", F.lit(r"(?i)<link\b[^>]*>"), F.lit(0)), lambda x: x.rlike("""(?i)rel=["']alternate["']""") & x.rlike("""(?i)type=["']application/(?:rss|atom)\\+xml["']"""))
    hrefs = homepages.select("url", F.posexplode(tags).alias("pos", "tag")).withColumn("feed_url", urls.resolve(F.regexp_extract("tag", """(?i)href=["']([^"']+)["']""", 1), F.col("url")))
    return hrefs.where("feed_url is not null").groupBy("url").agg(F.min_by("feed_url", "pos").alias("feed_url"))


def with_fallback(sources: DataFrame, fetched: DataFrame, homepages: DataFrame) -> DataFrame:
    """source_slug, url, body for feeds.signals: the body of each source's own feed, or where that could not be fetched,
    of the feed that its homepage names. sources: source_slug, url, homepage_url; fetched: url, body (null where the fetch
    failed) of all feeds; homepages: url, html."""
    got = fetched.where("body is not null").groupBy("url").agg(F.first("body").alias("body"))
    own = sources.join(got, "url", "left")
    lost = own.where("body is null and homepage_url <> url").select("source_slug", F.col("url").alias("failed"), F.col("homepage_url").alias("url"))
    found = lost.join(discovered(homepages), "url").where("feed_url <> failed").select("source_slug", F.col("feed_url").alias("url")).join(got, "url")
    return own.where("body is not null").select("source_slug", "url", "body").unionByName(found.select("source_slug", "url", "body"))

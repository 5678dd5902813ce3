"""Signals from pages (url, html): tiers of extraction, first match by tier and place.

The tiers are JSON-LD, articles and cards; in-page feeds replace rows without a trusted date; link titles and page
meta data serve where nothing else is found. A page is read once: each tier is an array of rows made by expressions on
the page's own row, a later tier only where the earlier ones left nothing, and what is left is exploded at the end. Nothing
needs Python or, without feeds, a shuffle. A url that comes in several rows is a page in each of them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.functions import dates, text, urls

# What marks a card, the characters read of it, the least characters of a title, results that end the search.
CARD = "(?:post|item(?!s-)|card|entry|story|article|blog)"
WINDOW, TITLE, ENOUGH = 1500, 15, 5
JSON_TYPES = ["BlogPosting", "Article", "NewsArticle", "ListItem"]
TAKE = 30


def group(c: Column, pattern: str, n: int = 1) -> Column:
    """The n-th group of the first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, n), F.lit(""))


def once(c: Column, f) -> Column:
    """f(c), evaluated in a lambda: long chains of patterns would outgrow what generated code may hold."""
    return F.transform(F.array(c), f)[0]


def heading(c: Column) -> Column:
    """title, href: of the first h1, else h2 to h6; else of an element whose class says headline or title, with its own
    href; else the text before the first tag."""
    levels = [group(c, rf"(?is)<h{i}[^>]*>(.*?)</h{i}>") for i in range(1, 7)]
    named = r'(?is)<([a-z]+)([^>]*class="[^"]*(?:headline|title)[^"]*"[^>]*)>(.{0,300}?)</\1>'
    level, inner, leading = F.coalesce(*levels), group(c, named, 3), group(c, rf"^{text.WS}*([^<]+)")
    title = text.strip_html(F.coalesce(level, inner, leading))
    return F.struct(title.alias("title"), F.when(level.isNull() & inner.isNotNull(), group(group(c, named, 2), r'(?i)href="([^"]+)"')).alias("href"))


# Names of the properties that hold a date, and of the months.
DATED = "datePublished|article:published_time|publishdate"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def published(c: Column, said: Column | None = None) -> Column:
    """The text of a date: time element, properties, then dates written in the text that shows (said, where it is known)."""
    name, value = f"""(?:itemprop|property|name)=["'](?:{DATED})["']""", """(?:content|datetime)=["']([^"']+)["']"""
    marked = [group(c, p) for p in (r"""(?i)<time[^>]*datetime=["']([^"']+)["'][^>]*>""", rf"(?i)<(?:meta|time)[^>]+{name}[^>]+{value}", rf"(?i)<(?:meta|time)[^>]+{value}[^>]+{name}")]
    written = [rf"(?i)\b((?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}})\b", rf"(?i)\b(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})\b", r"\b((?:19|20)\d{2}-\d{2}-\d{2})\b", r"\b((?:19|20)\d{2}年\d{1,2}月\d{1,2}日)"]
    told = lambda x: F.coalesce(*[group(x, p) for p in written])
    return F.coalesce(*marked, once(text_content(c), told) if said is None else told(said))


def text_content(c: Column) -> Column:
    """The text that shows: no scripts, no styles, no tag cut off at the end."""
    for p, to in ((r"(?is)<script.*?</script>", ""), (r"(?is)<style.*?</style>", ""), (r"<[^>]*$", ""), (r"<[^>]+>", " ")):
        c = F.regexp_replace(c, p, to)
    return text.trim_ws(F.regexp_replace(c, f"{text.WS}+", " "))


#: A row of a page. Its date is text; its link may be relative until resolved().
ROW = "struct<tier: int, pos: bigint, title: string, link: string, date: string, summary: string>"


def row(tier: int, pos: Column, title: Column, link: Column, date: Column, summary: Column) -> Column:
    return F.struct(F.lit(tier).alias("tier"), pos.cast("long").alias("pos"), title.alias("title"), link.alias("link"), date.alias("date"), summary.alias("summary"))


def clean(c: Column) -> Column:
    return once(c, lambda x: text.strip_html(text.decode_entities(x)))


def no_rows() -> Column:
    return F.array().cast(f"array<{ROW}>")


def matches(html: Column, pattern: str, n: int) -> Column:
    return F.coalesce(F.regexp_extract_all(html, F.lit(pattern), F.lit(n)), F.array().cast("array<string>"))


def ld_nodes(html: Column) -> Column:
    """struct(row, type, external_id) of each node of the page's JSON-LD. Malformed scripts give nothing."""

    def nodes(body: Column, k: Column) -> Column:
        listed = lambda root: F.coalesce(F.try_variant_get(root, '$["@graph"]', "array<variant>"), F.array(root))
        return F.transform(once(F.try_parse_json(body), listed), lambda node, nth: read(node, k.cast("long") * F.lit(1 << 32) + nth))

    def read(node: Column, pos: Column) -> Column:
        get = lambda *names: F.coalesce(*[F.try_variant_get(node, f'$["{n}"]', "string") for n in names])
        main = F.coalesce(F.try_variant_get(node, '$.mainEntityOfPage["@id"]', "string"), F.try_variant_get(node, "$.mainEntityOfPage.url", "string"), get("mainEntityOfPage"))
        whole = row(0, pos, get("headline", "name"), F.coalesce(get("url"), main), get("datePublished", "dateCreated"), get("description", "abstract", "headline", "name"))
        return F.struct(whole.alias("row"), get("@type").alias("type"), get("identifier", "@id").alias("external_id"))

    found = F.flatten(F.transform(matches(html, r'(?is)<script[^>]+type="application/ld\+json"[^>]*>(.*?)</script>', 1), nodes))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    good = F.filter(found, lambda x: x["type"].isin(JSON_TYPES) & filled(x["row"]["title"]) & filled(x["row"]["link"]))
    cleaned = lambda r: row(0, r["pos"], clean(r["title"]), r["link"], r["date"], F.substring(clean(r["summary"]), 1, 8000))
    return F.transform(good, lambda x: F.struct(cleaned(x["row"]).alias("row"), x["type"].alias("type"), x["external_id"].alias("external_id")))


def json_ld(pages: DataFrame) -> DataFrame:
    """page columns, pos and the node's title, url, date, id, summary, type."""
    out = pages.select(*pages.columns, F.explode(ld_nodes(F.col("html"))).alias("node"))
    return out.select(*pages.columns, "node.row.tier", "node.row.pos", "node.type", "node.row.link", "node.row.date", "node.external_id", "node.row.title", "node.row.summary")


def titled(bodies: Column, tier: int) -> Column:
    """Rows of card bodies (pos, href or null, body) with a heading. The link is the card's own, else that of the element
    that gave the title, else the first."""
    headed = F.transform(bodies, lambda x: F.struct(x["pos"].alias("pos"), x["href"].alias("href"), x["body"].alias("body"), heading(x["body"]).alias("head")))
    good = F.filter(headed, lambda x: (F.length(x["head"]["title"]) >= TITLE) & ~F.trim(x["head"]["title"]).rlike(r"(?i)^latest\s+.+\s+news$"))

    def whole(x: Column) -> Column:
        link = F.coalesce(x["href"], x["head"]["href"], group(x["body"], r'(?i)<a[^>]+href="([^"]+)"[^>]*>'))
        return once(text_content(x["body"]), lambda said: row(tier, x["pos"], clean(x["head"]["title"]), link, published(x["body"], said), clean(F.substring(said, 1, 500))))

    return F.filter(F.transform(good, whole), lambda r: r["link"].isNotNull())


def body(pos: Column, href: Column, c: Column) -> Column:
    return F.struct(pos.cast("long").alias("pos"), href.cast("string").alias("href"), c.alias("body"))


def article_rows(html: Column) -> Column:
    return titled(F.transform(matches(html, r"(?is)<article.*?>(.*?)</article>", 1), lambda c, k: body(k, F.lit(None), c)), 1)


# Opening tags of cards, in the order in which they are tried.
_NAMED = f'class="[^"]*{CARD}[^"]*"'
CARDS = [rf"<li[^>]*{_NAMED}[^>]*>", rf"<div[^>]*{_NAMED}[^>]*>", rf"<a[^>]*{_NAMED}[^>]*>", rf'<a[^>]+href="[^"]+"[^>]*>{text.WS}*<div[^>]*{_NAMED}[^>]*>']


def windows(html: Column, n: int) -> Column:
    """What follows each opening tag of a pattern, WINDOW characters: windows overlap, so a look-ahead holds them."""
    own = group(F.lit(""), "x") if n < 2 else None

    def cut(c: Column, k: Column) -> Column:
        href = own if own is not None else group(F.regexp_extract(c, "(?i)^<a([^>]*)>", 1), r'(?i)href="([^"]+)"')
        return body(F.lit(n << 40) + k, href, F.regexp_replace(c, f"(?i)^{CARDS[n]}", ""))

    return F.transform(matches(html, rf"(?i)(?=({CARDS[n]}[\s\S]{{0,{WINDOW}}})){CARDS[n]}", 1), cut)


def card_rows(html: Column) -> Column:
    """A pattern is tried while the earlier ones gave fewer than ENOUGH rows."""
    rows = titled(windows(html, 0), 2)
    for n in range(1, len(CARDS)):
        more = titled(windows(html, n), 2)
        rows = once(rows, lambda before: F.when(F.size(before) < ENOUGH, F.concat(before, more)).otherwise(before))  # noqa: B023
    return rows


def exploded(pages: DataFrame, rows: Column) -> DataFrame:
    return pages.select("url", F.explode(rows).alias("row")).select("url", "row.*")


def articles(pages: DataFrame) -> DataFrame:
    return exploded(pages, article_rows(F.col("html")))


def cards(pages: DataFrame) -> DataFrame:
    return exploded(pages, card_rows(F.col("html")))


def by_key(rows: Column, key, keep) -> Column:
    """The rows for which keep(their key, that before, that behind) holds when they are in order of key, tier and place;
    then in order of tier and place."""
    ordered = F.sort_array(F.transform(rows, lambda r: F.struct(key(r).alias("key"), r.alias("row"))))
    kept = once(ordered, lambda s: F.filter(s, lambda x, i: keep(x["key"], F.get(s, i - 1)["key"], F.get(s, i + 1)["key"])))
    return F.sort_array(F.transform(kept, lambda x: x["row"]))


def first_of_link(rows: Column) -> Column:
    return by_key(rows, lambda r: r["link"], lambda me, before, _: ~before.eqNullSafe(me))


def without_repeated_titles(rows: Column) -> Column:
    """Rows whose title, in any case, no other row of the page has."""
    return by_key(rows, lambda r: F.lower(r["title"]), lambda me, before, behind: ~before.eqNullSafe(me) & ~behind.eqNullSafe(me))


def resolved(rows: Column, url: Column) -> Column:
    whole = F.transform(rows, lambda r: r.withField("link", urls.resolve(r["link"], url)))
    return F.filter(whole, lambda r: r["link"].isNotNull())


def link_rows(html: Column, url: Column) -> Column:
    """Links with a title of 6 to 80 characters after the address; the first of a link, none to the page itself."""
    pattern = r'(?i)<a[^>]+href="([^"]+)"[^>]*\btitle="([^"]{6,80})"[^>]*>'

    def read(tag: Column, k: Column) -> Column:
        return once(clean(F.trim(F.regexp_extract(tag, pattern, 2))), lambda title: row(3, k, title, F.regexp_extract(tag, pattern, 1), F.lit(None).cast("string"), title))

    found = resolved(F.transform(matches(html, pattern, 0), read), url)
    return first_of_link(F.filter(found, lambda r: (r["title"] != "") & (r["link"] != url)))


def titled_links(pages: DataFrame) -> DataFrame:
    return exploded(pages, link_rows(F.col("html"), F.col("url")))


def feed_items(feed: Column) -> Column:
    """Rows of a feed as fetched, links as they stand there."""

    def read(item: Column, k: Column) -> Column:
        tag = lambda *names: F.coalesce(*[F.nullif(F.trim(F.regexp_extract(item, rf"(?i)<{n}[^>]*>([\s\S]*?)</{n}>", 1)), F.lit("")) for n in names])
        link = F.coalesce(group(item, r'(?i)<link[^>]+href="([^"]+)"'), tag("link"))
        summary = F.substring(clean(F.coalesce(tag("description", "summary"), tag("title"))), 1, 8000)
        return row(0, k, clean(tag("title")), link, tag("pubDate", "published"), summary)

    rows = F.transform(matches(feed, r"(?i)<(?:item|entry)>([\s\S]*?)</(?:item|entry)>", 1), read)
    return F.filter(rows, lambda r: r["title"].isNotNull() & r["link"].isNotNull())


def feed_link(html: Column) -> Column:
    kind = r'type="application/(?:rss|atom)\+xml"'
    return F.coalesce(group(html, rf'(?i)<link[^>]+{kind}[^>]+href="([^"]+)"'), group(html, rf'(?i)<link[^>]+href="([^"]+)"[^>]+{kind}'))


def meta(html: Column, name: str) -> Column:
    key = rf'(?:property|name)="{re.escape(name)}"'
    return F.coalesce(group(html, rf'(?i)<meta[^>]+{key}[^>]+content="([^"]*)"'), group(html, rf'(?i)<meta[^>]+content="([^"]*)"[^>]+{key}'))


def meta_rows(html: Column, url: Column) -> Column:
    """One row for a page that calls itself an article or news and has a date."""
    title = F.coalesce(meta(html, "og:title"), group(html, r"(?is)<title[^>]*>(.*?)</title>"))
    date, about = F.coalesce(meta(html, "article:published_time"), meta(html, "datePublished")), meta(html, "og:description")
    whole = row(4, F.lit(0), clean(title), F.coalesce(meta(html, "og:url"), url), date, F.substring(clean(F.coalesce(about, title)), 1, 8000))
    dated = F.filter(F.array(whole), lambda r: r["title"].isNotNull() & dates.parse_date(r["date"]).isNotNull())
    return F.when(meta(html, "og:type").rlike("(?i)article|news"), resolved(dated, url)).otherwise(no_rows())


def page_meta(pages: DataFrame) -> DataFrame:
    return exploded(pages, meta_rows(F.col("html"), F.col("url")))


def paragraphs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))


def excerpt(html: Column, least: int = 40, most: int = 1500) -> Column:
    """Paragraphs of `least` characters or more, of the article if there is one, until `most` are reached."""
    scope = F.coalesce(group(html, r"(?is)<article[^>]*>(.*?)</article>"), html)
    found = F.transform(paragraphs(scope), text.strip_html)
    long_ = F.filter(found, lambda p: F.length(p) >= least)
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("kept"))
    grown = F.aggregate(long_, start, lambda a, p: F.when(a["n"] >= most, a).otherwise(F.struct((a["n"] + F.length(p)).alias("n"), F.concat(a["kept"], F.array(p)).alias("kept"))))
    return F.nullif(F.substring(F.array_join(grown["kept"], " "), 1, most), F.lit(""))


def signals(pages: DataFrame, as_of: Column, take: int = TAKE, feeds: DataFrame | None = None) -> DataFrame:
    """url (the page), link, title, summary, published, inferred, tier, pos of the pages' rows: tiers together,
    the first of a link, no title that a page repeats, the first `take` of a page. Cards of another brand's site go.
    feeds (feed_url, feed_body): a page's feed with a date that is given replaces rows of which none has one. Pages
    without a row give their titled links (tier 3), pages without these their meta data (tier 4)."""
    html, url = F.col("html"), F.col("url")
    brand = lambda r: (r["tier"] == 0) | F.coalesce(urls.same_brand(urls.host(r["link"]), urls.host(url)), F.lit(True))
    tiers = F.concat(F.transform(ld_nodes(html), lambda x: x["row"]), article_rows(html), card_rows(html))
    named = urls.resolve(feed_link(html), url) if feeds is not None else F.lit(None).cast("string")
    rows = pages.select("url", "html", named.alias("feed_url"), F.filter(resolved(F.coalesce(tiers, no_rows()), url), brand).alias("rows"))
    rows = rows.withColumn("kept", without_repeated_titles(first_of_link(F.col("rows"))))
    later = once(link_rows(html, url), lambda found: F.when(F.size(found) > 0, found).otherwise(meta_rows(html, url)))
    rows = rows.withColumn("later", F.when((F.size("kept") == 0) | F.col("feed_url").isNotNull(), later).otherwise(no_rows())).drop("html")
    if feeds is not None:
        items = feeds.select("feed_url", feed_items(F.col("feed_body")).alias("items"))
        given = lambda c: F.exists(c, lambda r: dates.parse_date(r["date"]).isNotNull())
        rows = rows.join(items, "feed_url", "left").withColumn("items", resolved(F.coalesce("items", no_rows()), url))
        chosen = without_repeated_titles(first_of_link(F.col("items")))
        rows = rows.withColumn("kept", F.when(given(F.col("items")) & ~given(F.col("rows")), chosen).otherwise(F.col("kept")))
    first = F.slice(F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("later")), 1, take)
    out = rows.select("url", F.explode(first).alias("row")).select("url", "row.*", dates.dated(F.col("row.date"), as_of).alias("when"))
    return out.select("url", "link", "title", "summary", "when.published", "when.inferred", "tier", "pos")

"""Operators on pages, feeds and rows made up from the driver's tables, for forms that the given pages lack. What SQL
gives is written from the rules, not from the patterns that find it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigweave import schema
from sigweave.functions import dates, scoring, text, urls
from sigweave.operators import cluster, dedup, render, score, writer
from sigweave.sources import feeds, markdown, state
from sigweave.sources import pages as page_source
from sigweave.streaming.corroboration import EARLIER

from . import flows
from .queries import AS_OF, TOKENS, query, t

#: By page_id % 8: cards with a dummy link before the title's, a script, leading text only, a teaser, a date beside that of
#: an image, an upper-case entity, a short title, a class that only begins like a card's.
CARDS = [
    """<div class="card"><a href="javascript:void(0)">PRESS RELEASE</a><a class="link-title" href="/real/{id}">A long headline number {id}</a><time datetime='2024-01-05'>x</time></div>""",
    """<li class="post"><script>var x = "hidden words";</script><style>p {}</style><h3>Heading three of page {id}</h3><a href="/n/{id}">more</a><meta itemprop="datePublished" content="2024-02-03"></li>""",
    """<a class="story" href="/s/{id}">Leading text is the headline {id}</a>""",
    """<div class="entry"><h2>Latest Industry News</h2><a href="/c/{id}">x</a></div>""",
    """<div class="article"><p class="news-title">Date is in the text of {id}</p><img src="/2019-09-09/{id}.jpg"><a href="/d/{id}">go</a> on 24 July 2023</div>""",
    """<div class="blog"><h4>A&Uuml;b heading with entity {id}</h4><a href="/e/{id}">x</a></div>""",
    """<div class="item"><h2>Too short</h2><a href="/f/{id}">x</a></div>""",
    """<div class="items-center"><h2>No card has this heading {id}</h2><a href="/g/{id}">x</a></div>""",
]


def _pages(spark, sf, bodies: list[str]) -> DataFrame:
    """page_id, url, html: the body of page_id % len(bodies), with its {id}."""
    body = F.get(F.array(*[F.lit(b) for b in bodies]), (F.col("page_id") % len(bodies)).cast("int"))
    url = F.concat(F.lit("https://www.brand"), F.col("page_id").cast("string"), F.lit(".com/news"))
    html = F.concat(F.lit("<html><body>"), F.replace(body, F.lit("{id}"), F.col("page_id").cast("string")), F.lit("</body></html>"))
    return t(spark, sf, "pages").select("page_id", url.alias("url"), html.alias("html"))


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("page_id", F.regexp_extract("url", r"brand(\d+)", 1).cast("long"))


@query(
    """with c as (select page_id, page_id % 8 as k from pages)
    select page_id, case k when 0 then 'A long headline number ' when 1 then 'Heading three of page ' when 2 then 'Leading text is the headline ' when 4 then 'Date is in the text of ' else 'A&Uuml;b heading with entity ' end || page_id as title,
      case k when 0 then '/real/' when 1 then '/n/' when 2 then '/s/' when 4 then '/d/' else '/e/' end || page_id as link,
      case k when 0 then '2024-01-05' when 1 then '2024-02-03' when 4 then '24 July 2023' end as date,
      case k when 0 then 'PRESS RELEASE A long headline number ' || page_id || ' x' when 1 then 'Heading three of page ' || page_id || ' more' when 2 then 'Leading text is the headline ' || page_id
        when 4 then 'Date is in the text of ' || page_id || ' go on 24 July 2023' else 'A&Uuml;b heading with entity ' || page_id || ' x' end as summary
    from c where k in (0, 1, 2, 4, 5)"""
)
def page_cards(spark, sf):
    return _numbered(page_source.cards(_pages(spark, sf, CARDS))).select("page_id", "title", "link", "date", "summary")


@query(
    """select page_id, case when page_id % 3 = 0 then 'Graph ' || page_id || ' & more' else 'Named ' || page_id end as title, case when page_id % 3 = 0 then '/j/' else 'https://x.com/m/' end || page_id as link,
    '2024-01-0' || (page_id % 3 + 1) as date, case when page_id % 3 = 0 then 'About ' || page_id else 'Named ' || page_id end as summary from pages where page_id % 3 < 2"""
)
def page_json_ld(spark, sf):
    graph = """<script type="application/ld+json">{"@graph":[{"@type":"Person","name":"no"},{"@type":"NewsArticle","headline":"Graph {id} &amp; more","url":"/j/{id}","datePublished":"2024-01-01","description":"<b>About</b> {id}"}]}</script>"""
    one = """<script type="application/ld+json">{"@type":"Article","name":"Named {id}","mainEntityOfPage":{"@id":"https://x.com/m/{id}"},"dateCreated":"2024-01-02"}</script>"""
    broken = """<script type="application/ld+json">{"@type":"Article","name":"Broken</script>"""
    return _numbered(page_source.json_ld(_pages(spark, sf, [graph, one, broken]))).select("page_id", "title", "link", "date", "summary")


@query(
    "with recursive v(k, authority, is_primary) as (values " + ", ".join(f"({k}, {s[5]}, {str(s[6]).lower()})" for k, s in enumerate(schema.SOURCES)) + f"""),
    d as (select doc_id + case when doc_id % 3 = 0 then 1000000 else 0 end as seq, doc_id as h, doc_id % 16 as source, {TOKENS.replace('[^a-z0-9]', '[^a-z0-9一-鿿]')} as k from documents),
    x as (select a.seq as a, b.seq as b, len(list_intersect(a.k, b.k)) as n, len(a.k) as p, len(b.k) as q from d a join d b on a.seq < b.seq and abs(b.h - a.h) <= 96), e as (select a, b from x where p > 0 and q > 0 and n / cast(p + q - n as double) >= 0.46),
    r(seq, low) as (select seq, seq from d union select e.b, r.low from r join e on e.a = r.seq), c as (select seq, min(low) as cluster_id from r group by seq),
    g as (select cluster_id, count(distinct source) as cluster_size from c join d using (seq) group by 1)
    select seq, cluster_id, cluster_size, cast(greatest(0, least(100, floor(authority * 0.6::double + case when is_primary then 20 else 0 end + least(cluster_size - 1, 3) * 10 + 0.5))) as integer) as confidence
    from d join c using (seq) join g using (cluster_id) join v on v.k = source where seq < 1000000"""
)
def scored_with_context(spark, sf):
    """Two of three documents scored among all: the others are of earlier days and come after them in order."""
    d = t(spark, sf, "documents")
    at = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = d.select(F.col("doc_id").alias("seq"), _one_of([s[0] for s in schema.SOURCES], F.col("doc_id")).alias("sourceSlug"), F.split("text", "\n")[0].alias("title"), F.lit("").alias("summary"), F.lit("tech").alias("category"), at.alias("publishedAt"), F.struct(F.lit(False).alias("dateInferred")).alias("rawMeta"))
    earlier = rows.where("seq % 3 = 0").withColumn("seq", F.col("seq") + EARLIER)
    return score.scored(rows.where("seq % 3 <> 0"), F.lit(AS_OF).cast("timestamp"), earlier).select("seq", "cluster_id", "cluster_size", "confidence")


@query(
    """with s as (select s_suppkey as n, s_name as name, date '2024-01-01' + cast(7 * s_suppkey as integer) as m from supplier where s_suppkey % 4 <> 3)
    select strftime(m, '%Y-%m-%d') as monday, '# Week of ' || name || chr(10) || chr(10) || '> ' || month(m) || '月' || day(m) || '日 – ' || month(m + 6) || '月' || day(m + 6) || '日（上周）' || chr(10) || chr(10) || 'Told ' || n || chr(10) || chr(10) || '## 上周十大热点' || chr(10) || chr(10)
      || '**1. First ' || n || '**' || chr(10) || chr(10) || 'new（[' || name || '](https://s.com/' || n || ')）' || chr(10) || chr(10) || '**2. Second**' || chr(10) || chr(10) || 'no source' || chr(10) as markdown from s"""
)
def weekly_markdown(spark, sf):
    """Responses of which one in four lacks its briefing: the last item of an index serves, items without a row go."""
    s = t(spark, sf, "supplier").withColumn("n", F.col("s_suppkey").cast("string"))
    s = s.withColumn("monday", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_suppkey").cast("int") * 7), "yyyy-MM-dd"))
    item = lambda index, heading, body: F.struct(F.lit(index).alias("index"), heading.alias("heading"), F.lit(body).alias("body"))
    items = F.array(item(2, F.lit("Second"), "no source"), item(1, F.lit("Old"), "old"), item(1, F.concat(F.lit("First "), "n"), "new"), item(9, F.lit("No row"), "x"))
    said = F.to_json(F.struct(F.concat(F.lit("Week of "), "s_name").alias("headline"), F.when(F.col("s_suppkey") % 4 != 3, F.concat(F.lit("Told "), "n")).alias("briefing"), items.alias("items")))
    rows = s.select("monday", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("index"), F.col("s_name").alias("source_name"), F.concat(F.lit("https://s.com/"), "n").alias("url")).withColumn("url", F.when(F.col("index") != 2, F.col("url")))
    return render.weekly(s.select("monday", render.checked_weekly(said).alias("r")), rows)


#: By page_id % 6: plain; in capitals, with an entity and the page itself; the title first, which is no such link, then one
#: whose address comes first; single quotes; a tag within other tags and a title of tags; a relative address and dots.
LINKS = [
    """<a href="/t/{id}" class="x" title="Title of link {id}">x</a><a href="/t/{id}" title="The same again">y</a><a href="/u/{id}" title="short">z</a><a href="/news" title="The page itself">z</a>""",
    """<A HREF="/c/{id}" TITLE="Signs &amp; more {id}">x</A><A HREF="https://www.brand{id}.com/news" TITLE="The page again">x</A>""",
    """<a title="Title comes first" href="/no/{id}">x</a><a rel="nofollow" href="/b/{id}" data-x="1" title="Address first {id}">x</a>""",
    """<a href='/s/{id}' title='Single quotes {id}'>x</a>""",
    """<div><p><a href="/d/{id}" title="<b>Deep</b> within {id}"><img src="x"></a></p></div>""",
    """<a href="../r/./{id}?q=1#f" title="Relative one {id}">x</a><a href="mailto:a@b.c" title="No page at all">x</a>""",
]


@query(
    """with r(k, title, path) as (values (0, 'Title of link ', '/t/'), (1, 'Signs & more ', '/c/'), (2, 'Address first ', '/b/'), (4, 'Deep within ', '/d/'), (5, 'Relative one ', '/r/'))
    select page_id, title || page_id as title, 'https://www.brand' || page_id || '.com' || path || page_id || case when k = 5 then '?q=1#f' else '' end as link from pages join r on k = page_id % 6"""
)
def page_titled_links(spark, sf):
    return _numbered(page_source.titled_links(_pages(spark, sf, LINKS))).select("page_id", "title", "link")


@query(
    """select page_id, 'https://www.brand' || page_id || '.com/' || case page_id % 4 when 0 then 'told/' || page_id when 1 then 'x/' || page_id when 2 then 'dated/' || page_id else 'x/' || page_id end as link,
      case page_id % 4 when 0 then 'Told by the feed ' when 2 then 'An article with a date ' else 'An article without date ' end || page_id as title, page_id % 4 not in (0, 2) as inferred from pages"""
)
def page_feed_override(spark, sf):
    """A page's own feed, with a date, stands in for rows of which none has one: not where the feed has none, where a row
    has one, or where the feed is not there."""
    named, plain = """<link rel="alternate" type="application/rss+xml" href="/feed/{id}">""", """<article><h2>An article without date {id}</h2><a href="/x/{id}">x</a></article>"""
    dated = """<article><h2>An article with a date {id}</h2><time datetime="2024-01-05">x</time><a href="/dated/{id}">x</a></article>"""
    pages = _pages(spark, sf, [named + plain, named + plain, named + dated, named + plain])
    key = F.regexp_extract("url", r"brand(\d+)", 1)
    date = F.when(key.cast("long") % 4 != 1, F.lit("<pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate>")).otherwise(F.lit(""))
    body = F.concat(F.lit("<rss><channel><item><title>Told by the feed "), key, F.lit("</title><link>/told/"), key, F.lit("</link>"), date, F.lit("</item></channel></rss>"))
    bodies = pages.where("page_id % 4 <> 3").select(F.concat(F.regexp_replace("url", "/news$", "/feed/"), key).alias("feed_url"), body.alias("feed_body"))
    return _numbered(page_source.signals(pages, F.lit(AS_OF).cast("timestamp"), feeds=bodies)).select("page_id", "link", "title", "inferred")


@query("""select p_partkey, replace(replace(replace('<' || p_name || ' & "' || p_partkey || '">', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as escaped from part""")
def html_escape(spark, sf):
    return t(spark, sf, "part").select("p_partkey", text.escape_html(F.concat(F.lit("<"), "p_name", F.lit(' & "'), "p_partkey", F.lit('">'))).alias("escaped"))


@query(
    """select p_partkey, '<h1>' || p_name || '</h1>' || chr(10) || '<blockquote><p>Told of <strong>' || p_partkey || '</strong></p></blockquote>' || chr(10) || '<ul><li>one &lt;' || p_partkey || '&gt;</li><li>two &amp; <a href="https://x.com/' || p_partkey || '">more</a></li></ul>'
      || chr(10) || case when p_partkey % 2 = 0 then '<h3>Part' || '</h3>' || chr(10) else '' end || '<p>A line' || chr(10) || 'and another</p>' as body from part"""
)
def markdown_html(spark, sf):
    key, p = F.col("p_partkey").cast("string"), t(spark, sf, "part")
    lines = F.concat(F.lit("# "), "p_name", F.lit("\n\n> Told of **"), key, F.lit("**\n\n- one <"), key, F.lit(">\n- two & [more](https://x.com/"), key, F.lit(")\n \n"), F.when(F.col("p_partkey") % 2 == 0, F.lit("### Part\n\n")).otherwise(F.lit("\n")), F.lit("A line\nand another\n\n"))
    return p.select("p_partkey", markdown.html(lines).alias("body"))


@query(
    """select cast(row_number() over (order by n desc) as integer) as place, strftime(date '2024-01-01' + cast(7 * n as integer), '%Y-%m-%d') as monday, 'Week ' || n as title from (select s_suppkey as n from supplier where s_suppkey % 3 <> 0)"""
)
def weekly_index(spark, sf):
    """Weekly documents, the newest first; files of other names are no weeks."""
    n = F.col("s_suppkey").cast("int")
    name = F.when(n % 3 == 0, F.concat(F.lit("notes-"), n.cast("string"), F.lit(".md"))).otherwise(F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), n * 7), "yyyy-MM-dd"), F.lit(".md")))
    rows = t(spark, sf, "supplier").select(name.alias("filename"), F.concat(F.lit("# Week "), n.cast("string"), F.lit("\n\ntext")).alias("content"))
    listed = markdown.weeks(rows).select("monday", "title")
    # weeks() puts them in order; their places are those of the order
    return listed.withColumn("place", F.row_number().over(Window.orderBy(F.col("monday").desc()))).select("place", "monday", "title")


@query("select page_id, 'Meta title ' || page_id as title, 'https://www.brand' || page_id || '.com/' || case when page_id % 4 = 0 then 'o/' || page_id else 'news' end as link, '2024-01-05T00:00:00Z' as date from pages where page_id % 4 in (0, 1)")
def page_meta_rows(spark, sf):
    dated = """<meta property="article:published_time" content="2024-01-05T00:00:00Z">"""
    bodies = [
        f"""<meta property="og:type" content="article"><meta content="Meta title {{id}}" property="og:title"><meta property="og:url" content="/o/{{id}}">{dated}""",
        f"""<meta property="og:type" content="news"><title>Meta title {{id}}</title>{dated}""",
        f"""<meta property="og:type" content="website"><title>No article {{id}}</title>{dated}""",
        """<meta property="og:type" content="article"><title>No date {id}</title>""",
    ]
    return _numbered(page_source.page_meta(_pages(spark, sf, bodies))).select("page_id", "title", "link", "date")


@query("select page_id, 'https://www.brand' || page_id || '.com/' || case when page_id % 3 = 0 then 'feed/' || page_id else 'atom/' || page_id end as feed_url from pages where page_id % 3 < 2")
def feed_discovery(spark, sf):
    bodies = [
        """<link rel="stylesheet" href="/x.css"><link rel="alternate" type="application/rss+xml" href="/feed/{id}"><link rel="alternate" type="application/rss+xml" href="/second">""",
        """<link href='/atom/{id}' type='application/atom+xml' rel='alternate'>""",
        """<link rel="alternate" type="text/html" href="/de">""",
    ]
    return _numbered(feeds.discovered(_pages(spark, sf, bodies))).select("page_id", "feed_url")


@query(
    """with f as (select c_custkey, c_name, unnest(range(c_custkey % 4)) as n from customer)
    select c_custkey, cast(n as integer) as pos, c_name || ' ' || n as title, 'https://f' || c_custkey || '.com/i/' || n as link, case when n = 1 then 'g' || c_custkey else 'https://f' || c_custkey || '.com/i/' || n end as external_id,
      case when n = 2 then c_name || ' ' || n else 'About ' || n end as summary, n = 2 as inferred from f"""
)
def feed_items(spark, sf):
    """Feeds of 0 to 3 items: dated, with a guid, without date and description."""
    n, key = F.col("n").cast("string"), F.col("c_custkey").cast("string")
    body = F.concat(F.when(F.col("n") == 2, F.lit("")).otherwise(F.concat(F.lit("<description><![CDATA[<p>About</p> "), n, F.lit("]]></description><pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate>"))), F.when(F.col("n") == 1, F.concat(F.lit("<guid>g"), key, F.lit("</guid>"))).otherwise(F.lit("")))
    item = F.concat(F.lit("<item><title>"), F.col("c_name"), F.lit(" "), n, F.lit("</title><link>/i/"), n, F.lit("</link>"), body, F.lit("</item>"))
    rows = t(spark, sf, "customer").withColumn("n", F.explode(F.slice(F.array(*[F.lit(i) for i in range(4)]), F.lit(1), (F.col("c_custkey") % 4).cast("int"))))
    whole = rows.groupBy("c_custkey").agg(F.sort_array(F.collect_list(F.struct("n", item.alias("item")))).alias("items"))
    xml = F.concat(F.lit("<rss><channel><title>t</title>"), F.array_join(F.transform("items", lambda x: x["item"]), ""), F.lit("</channel></rss>"))
    got = feeds.signals(whole.select(F.concat(F.lit("https://f"), F.col("c_custkey").cast("string"), F.lit(".com/")).alias("url"), xml.alias("body")), F.lit(AS_OF).cast("timestamp"))
    return got.select(F.regexp_extract("url", r"f(\d+)", 1).cast("long").alias("c_custkey"), "pos", "title", "link", "external_id", "summary", "inferred")


#: By c_custkey % 8: RSS of two items, Atom of one entry with two links, one item, an item told of in CDATA, both roots' children in
#: one, a document of another root, an entity that only HTML knows, and entries in a channel.
FEEDS = [
    """<?xml version="1.0"?><!-- feed --><rss version="2.0"><channel><title>t</title><item><title>One {id}</title><link>/1/{id}</link></item><item><title>Two {id}</title><link>/2/{id}</link><guid isPermaLink="false">g{id}</guid></item></channel></rss>""",
    """<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry><title type="html">Atom {id} &amp; more</title><link rel="self" href="/self/{id}"/><link rel="alternate" href="/a/{id}"/><id>urn:{id}</id></entry></feed>""",
    """<rss><channel><item><title>Alone {id}</title><link>https://x.com/{id}</link></item></channel></rss>""",
    """<rss><channel><item><title>Outer {id}</title><link>/o/{id}</link><description><![CDATA[<item><title>Inner</title><link>/i</link></item> of {id}]]></description></item></channel></rss>""",
    """<rss><channel><item><title>Of rss {id}</title><link>/r/{id}</link></item></channel><feed><entry><title>Of feed</title><link>/f</link></entry></feed></rss>""",
    """<list><item><title>No feed {id}</title><link>/n/{id}</link></item></list>""",
    """<rss><channel><item><title>Torn&nbsp;{id}</title></item><item><title>Whole {id}</title><link>/w/{id}</link></item></channel></rss>""",
    """<rss><channel><entry><title>No item {id}</title><link>/e/{id}</link></entry></channel></rss>""",
]


@query(
    """with r(k, pos, title, link, id) as (values (0, 0, 'One ', '/1/', null), (0, 1, 'Two ', '/2/', 'g'), (1, 0, 'Atom ', '/a/', 'urn:'), (2, 0, 'Alone ', 'https://x.com/', null), (3, 0, 'Outer ', '/o/', null), (4, 0, 'Of rss ', '/r/', null), (6, 1, 'Whole ', '/w/', null))
    select c_custkey, cast(pos as integer) as pos, title || c_custkey || case when k = 1 then ' & more' else '' end as title, case when link like '/%' then 'https://f' || c_custkey || '.com' else '' end || link || c_custkey as link,
      case when id is null then case when link like '/%' then 'https://f' || c_custkey || '.com' else '' end || link || c_custkey else id || c_custkey end as external_id from customer join r on k = c_custkey % 8"""
)
def feed_structure(spark, sf):
    """Feeds by their root: rss.channel.item, else feed.entry."""
    body = F.replace(_one_of(FEEDS, F.col("c_custkey")), F.lit("{id}"), F.col("c_custkey").cast("string"))
    bodies = t(spark, sf, "customer").select(F.concat(F.lit("https://f"), F.col("c_custkey").cast("string"), F.lit(".com/")).alias("url"), body.alias("body"))
    got = feeds.signals(bodies, F.lit(AS_OF).cast("timestamp"))
    return got.select(F.regexp_extract("url", r"f(\d+)", 1).cast("long").alias("c_custkey"), "pos", "title", "link", "external_id")


@query(
    """select c_custkey, 'lta-coe-2024-02-2' as external_id, '新加坡 COE Category D（摩托车）最新中标价：S$' || format('{:,}', 9000 + c_custkey) || '（2024-02 第2轮）' as title,
    '2024-02 第1轮：中标价 S$8,500（配额 400，收到投标 700 份，中标 390 份）；2024-02 第2轮：中标价 S$' || format('{:,}', 9000 + c_custkey) || '（配额 ' || c_custkey % 500 || '，收到投标 600 份，中标 350 份）' as summary, '2024-02-01' as day from customer"""
)
def bidding_signals(spark, sf):
    key = F.col("c_custkey")
    lines = [F.lit("bidding_no,month,vehicle_class,quota,bids_success,bids_received,premium"), F.lit("2,2024-01,Category D,300,290,500,8001"), F.lit("1,2024-02,Category D,400,390,700,8500"), F.lit("1,2024-02,Category A,1,1,1,99999")]
    last = F.concat(F.lit("2,2024-02,Category D,"), (key % 500).cast("string"), F.lit(",350,600,"), (key + 9000).cast("string"))
    bodies = t(spark, sf, "customer").select(F.concat(F.lit("https://c/"), key.cast("string")).alias("url"), F.concat_ws("\r\n", *lines, last, F.lit("2,2024-02,Category E,1,1,1,5"), F.lit("")).alias("body"))
    got = feeds.bid_signals(bodies, F.lit(AS_OF).cast("timestamp"))
    return got.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("c_custkey"), "external_id", "title", "summary", F.date_format("published", "yyyy-MM-dd").alias("day"))


NAMES = ["New Honda CB {id}", "hondas and such {id}", "雅马哈 MT-{id}", "BMW Motorrad R {id}", "Royal  Enfield {id} and Triumph", "a round of MotoGP {id}", "nothing {id}"]


@query("select p_partkey, ['honda', null, 'yamaha', 'bmw-moto', 'triumph', 'motogp', null][p_partkey % 7 + 1] as fp from part")
def title_fingerprints(spark, sf):
    title = F.replace(F.get(F.array(*[F.lit(n) for n in NAMES]), (F.col("p_partkey") % 7).cast("int")), F.lit("{id}"), F.col("p_partkey").cast("string"))
    return t(spark, sf, "part").select("p_partkey", text.fingerprint(title).alias("fp"))


@query("select p_partkey, substr(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 90) as slug from part")
def title_slugs(spark, sf):
    return t(spark, sf, "part").select("p_partkey", text.slugify(F.concat(F.lit(" #"), F.col("p_name"), F.lit("! "))).alias("slug"))


@query(
    """select o_orderkey, case when o_orderkey % 3 = 0 then 'x' || o_orderkey when o_orderkey % 3 = 1 then 'https://a.com/p' || o_orderkey else 'title ' || o_orderkey end as dedup_key,
    case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m') || '-01' else '2024-01-31' end as month_start, 'https://***@h/' || o_orderkey as redacted from orders"""
)
def row_keys(spark, sf):
    """Keys by id, else canonical url, else title; first days of months, the run's day for what is no month; urls without
    credentials."""
    key, n = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    named = urls.dedup_key(F.when(n == 0, F.concat(F.lit("x"), key)).otherwise(F.lit("")), F.when(n == 1, F.concat(F.lit("HTTPS://A.com:443/p"), key, F.lit("/?utm_source=z#top"))), F.concat(F.lit("title "), key))
    month = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.lit("someday"))
    start = F.date_format(dates.month_start(month, F.lit(AS_OF).cast("timestamp")), "yyyy-MM-dd")
    return t(spark, sf, "orders").select("o_orderkey", named.alias("dedup_key"), start.alias("month_start"), urls.redact(F.concat(F.lit("https://user:secret@h/"), key)).alias("redacted"))


@query("select c_custkey, ['racing','new-models','culture','local-market','tech','industry','other'][c_custkey % 7 + 1] as category, [60, 60, 50, 45, 45, 35, 40][c_custkey % 7 + 1] as weight from customer")
def category_weights(spark, sf):
    category = F.get(F.array(*[F.lit(c) for c in [*scoring.WEIGHTS, "other"]]), (F.col("c_custkey") % 7).cast("int"))
    rows = t(spark, sf, "customer").select("c_custkey", category.alias("category"))
    return rows.withColumn("weight", scoring.weight(F.col("category")))


@query("select a.doc_id as a, b.doc_id as b from documents a join documents b on a.source = b.source and a.lang = b.lang and a.doc_id < b.doc_id and b.doc_id - a.doc_id <= 504")
def fp_edges_window(spark, sf):
    """Documents an hour apart, their sources as fingerprints."""
    rows = t(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 3600).alias("ts"), F.col("lang").alias("category"), F.col("source").alias("fp"), F.array().cast("array<string>").alias("tokens"))
    return cluster.links(rows)


LINKED = "select a.n_nationkey as a, b.n_nationkey as b from nation a join nation b on a.n_nationkey < b.n_nationkey and (a.n_nationkey * 7 + b.n_nationkey * 3) % 13 = 0"


@query(
    f"""with recursive e as ({LINKED}), n as (select n_nationkey as b, (select coalesce(list(a), []) from e where e.b = n_nationkey) as before from nation),
    r(k, groups) as (select 0, [0] union all select k + 1, list_append(groups, coalesce(list_min(list_transform(before, lambda x: groups[x + 1])), k + 1)) from r join n on n.b = r.k + 1)
    select cast(k.seq as bigint) as seq, cast(groups[k.seq + 1] as bigint) as cluster_id from (select groups from r order by k desc limit 1), (select a as seq from e union select b from e) k"""
)
def first_fit_groups(spark, sf):
    """Nations linked by their keys: a row joins the first group that holds a linked one."""
    n = t(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    edges = n.toDF("a").join(n.toDF("b"), F.expr("a < b and (a * 7 + b * 3) % 13 = 0"))
    return cluster.first_fit(edges)


def _one_of(values: list, key) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


TIERS = [
    """<script type="application/ld+json">{"@type":"Article","headline":"Told by data of page {id}","url":"/a/{id}"}</script><article><h2>Told by the article {id}</h2><a href="/a/{id}">x</a></article><article><h2>Another article of {id}</h2><a href="/b/{id}">x</a></article>""",
    """<article><h2>An article beside cards {id}</h2><a href="/c/{id}">x</a></article><div class="card"><h3>A card beside articles {id}</h3><a href="/d/{id}">x</a></div><div class="card"><h3>A card of another house {id}</h3><a href="https://www.elsewhere.org/{id}">x</a></div>""",
    """<article><h2>The same title twice {id}</h2><a href="/e/{id}">x</a></article><article><h2>The Same title twice {id}</h2><a href="/f/{id}">x</a></article><a href="/g/{id}" title="Only a link's title {id}">x</a>""",
    """<meta property="og:type" content="article"><meta property="og:title" content="Only meta data {id}"><meta property="article:published_time" content="2024-01-05T00:00:00Z">""",
    """<p>Nothing here</p>""",
]


@query(
    """with r(k, tier, path, title) as (values (0, 0, 'a', 'Told by data of page '), (0, 1, 'b', 'Another article of '), (1, 1, 'c', 'An article beside cards '), (1, 2, 'd', 'A card beside articles '), (2, 3, 'g', 'Only a link''s title '), (3, 4, '', 'Only meta data '))
    select page_id, tier, title || page_id as title, 'https://www.brand' || page_id || '.com/' || case when path = '' then 'news' else path || '/' || page_id end as link, k = 3 as dated from pages join r on k = page_id % 5"""
)
def union_tiers(spark, sf):
    """Tiers together: the first of a link wins, other houses' cards and titles that repeat go, later tiers fill in."""
    got = _numbered(page_source.signals(_pages(spark, sf, TIERS), F.lit(AS_OF).cast("timestamp")))
    return got.select("page_id", "tier", "title", "link", (~F.col("inferred")).alias("dated"))


@query("select page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || link as link from (select page_id, url, unnest(regexp_extract_all(html, '(?i)<a[^>]+href=\"(/[^\"/][^\"]*)\"', 1)) as link from pages)")
def page_links(spark, sf):
    """Links of pages, which all begin with a slash, made whole."""
    found = t(spark, sf, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'(?i)<a[^>]+href="([^"]+)"'), F.lit(1))).alias("link"))
    return found.select("page_id", urls.resolve(F.col("link"), F.col("url")).alias("link"))


@query("select page_id, cast(len(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1)) as bigint) as paragraphs from pages")
def page_paragraph_count(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.size(page_source.paragraphs(F.col("html"))).cast("long").alias("paragraphs"))


SLUGS = [s[0] for s in schema.SOURCES] + [None, "unknown"]


@query(
    "with s(slug, authority, is_primary) as (values " + ", ".join(f"('{s[0]}', {s[5]}, {str(s[6]).lower()})" for s in schema.SOURCES) + f"""), o as (select o_orderkey, [{", ".join("null" if s is None else f"'{s}'" for s in SLUGS)}][o_orderkey % {len(SLUGS)} + 1] as slug from orders)
    select o_orderkey, authority, coalesce(is_primary, false) as is_primary, cast(floor(coalesce(authority, 50) * 0.6::double + case when is_primary then 20 else 0 end + 0.5) as integer) as confidence from o left join s using (slug)"""
)
def source_dim_join_default(spark, sf):
    """Orders as signals of the sources, of none and of one that isn't known."""
    o = t(spark, sf, "orders").select("o_orderkey", _one_of(SLUGS, F.col("o_orderkey")).alias("source_slug"))
    return score.with_source(o).select("o_orderkey", "authority", "is_primary", scoring.confidence(F.col("authority"), F.col("is_primary"), F.lit(1)).alias("confidence"))


@query("select l_partkey, count(distinct l_suppkey) as sources from lineitem group by l_partkey")
def independent_source_count(spark, sf):
    rows = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("cluster_id"), F.col("l_suppkey").alias("source_slug"))
    return cluster.sizes(rows).toDF("l_partkey", "sources")


@query("select strftime(o_orderdate, '%Y-%m') as month, string_agg('S$' || format('{:,}', cast(floor(o_totalprice) as bigint)), '；' order by o_orderkey) as summary from orders group by 1")
def rounds_summary(spark, sf):
    o = t(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", "o_totalprice")
    return render.joined(o, "month", ["o_orderkey"], F.concat(F.lit("S$"), F.format_number(F.floor("o_totalprice"), 0)), "；").withColumnRenamed("text", "summary")


@query("select p_partkey, 'item-' || substr(sha256(repeat('!', 1 + p_partkey % 90) || '?'), 1, 12) as slug from part")
def hash_sha256(spark, sf):
    """Slugs of titles without a letter: their hash."""
    bare = F.concat(F.repeat(F.lit("!"), (F.col("p_partkey") % 90 + 1).cast("int")), F.lit("?"))
    return t(spark, sf, "part").select("p_partkey", text.slugify(bare).alias("slug"))


@query(
    """with f as (select '2024-' || lpad(cast(c_custkey % 12 + 1 as varchar), 2, '0') || '-' || lpad(cast(c_custkey // 12 % 28 + 1 as varchar), 2, '0') as date, c_custkey // 336 as k, c_custkey, c_name from customer where c_custkey // 336 < 3 and c_custkey % 7 > 0),
    p as (select date, list({'filename': date || '-子推送-' || k || 'ab.md', 'title': c_name} order by k) as pushes from f where k > 0 group by 1)
    select date, c_name as title, cast(c_custkey % 4 as integer) as item_count, array_to_string(list_transform(range(0, least(3, c_custkey % 5)), lambda i: 'point ' || i), '|') as highlights,
      coalesce(array_to_string(list_transform(pushes, lambda p: p.filename || '=' || p.title), '|'), '') as pushes, month(cast(date as date)) || '月' || day(cast(date as date)) || '日 · 周' || substr('日一二三四五六', dayofweek(cast(date as date)) + 1, 1) as header from f left join p using (date) where k = 0"""
)
def markdown_index(spark, sf):
    """Customers as the files of a folder: a day's main file and two pushes of some days, and names that don't count."""
    c, key = t(spark, sf, "customer"), F.col("c_custkey")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    date = F.concat(F.lit("2024-"), two(key % 12 + 1), F.lit("-"), two((F.floor(key / 12) % 28).cast("int") + 1))
    k = F.floor(key / 336)
    name = F.when(key % 7 == 0, F.lit("notes.md")).when(k == 0, F.concat(date, F.lit(".md"))).otherwise(F.concat(date, F.lit("-子推送-"), k.cast("string"), F.lit("ab.md")))
    points = F.array_join(F.transform(F.slice(F.array(*[F.lit(i) for i in range(5)]), F.lit(1), (key % 5).cast("int")), lambda i: F.concat(F.lit("- point "), i.cast("string"), F.lit("\n"))), "")
    body = F.concat(F.lit("# "), F.when(k > 0, F.lit("子推送：")).otherwise(F.lit("")), F.col("c_name"), F.lit("\n\n## 今日热点导览\n\n"), points, F.lit("\n## s\n\n"), F.repeat(F.lit("**bold**\n\ntext\n\n"), (key % 4).cast("int")))
    days = markdown.days(markdown.entries(c.where(k < 3).select(name.alias("filename"), body.alias("content"))))
    pushes = F.coalesce(F.array_join(F.transform("pushes", lambda p: F.concat(p["filename"], F.lit("="), p["title"])), "|"), F.lit(""))
    return days.select("date", "title", "item_count", F.array_join("highlights", "|").alias("highlights"), pushes.alias("pushes"), "header")


@query(
    """with s as (select c_mktsegment as source_slug, 'k' || c_custkey as dedup_key, timestamp '2024-01-01' + (c_custkey % 60) * interval 1 day as first_seen from customer)
    select source_slug, '{"' || source_slug || '":{' || string_agg('"' || dedup_key || '":"' || strftime(first_seen, '%Y-%m-%dT%H:%M:%S.000Z') || '"', ',' order by dedup_key) || '}}' as body from s where first_seen >= timestamp '2024-01-25' group by 1"""
)
def state_json(spark, sf):
    """A state read from JSON text, kept for 30 days and written as such."""
    at = F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 60).cast("int")), "yyyy-MM-dd"), F.lit("T00:00:00.000Z"))
    entry = F.to_json(F.create_map("c_mktsegment", F.create_map(F.concat(F.lit("k"), F.col("c_custkey").cast("string")), at)))
    rows = state.parsed(t(spark, sf, "customer").select(entry.alias("body")))
    return state.as_json(dedup.pruned(rows, F.lit("2024-02-24").cast("timestamp")))


ADDRESSES = ["http://example.com/{id}", "https://u:p@example.com/{id}", "ftp://example.com/{id}", "http://127.0.0.1/{id}", "http://192.168.4.5:8080/{id}", "https://localhost/{id}", "http://169.254.1.1/{id}", "https://93.184.216.34/{id}"]


@query("select p_partkey, p_partkey % 8 in (0, 7) as safe, p_partkey % 3 < 2 as same_brand from part")
def url_checks(spark, sf):
    """Urls that may be fetched; hosts of one house."""
    url = F.replace(_one_of(ADDRESSES, F.col("p_partkey")), F.lit("{id}"), F.col("p_partkey").cast("string"))
    other = _one_of(["news.honda.com.my", "global.honda", "www.yamaha-motor.com"], F.col("p_partkey"))
    return t(spark, sf, "part").select("p_partkey", urls.safe_url(url).alias("safe"), urls.same_brand(F.lit("www.honda.co.uk"), F.when(other == "global.honda", F.lit("hondaracing.com")).otherwise(other)).alias("same_brand"))


@query(
    """select c_custkey, case when c_custkey % 3 = 1 or c_custkey % 2 = 1 then 'short ' || c_custkey when c_custkey % 5 = 0 then 'short ' || c_custkey else 'The fetched article of ' || c_custkey || ' has a paragraph that is long enough.' end as summary from customer"""
)
def enriched_summaries(spark, sf):
    """Customers as rows; excerpts of fetched articles serve scraped rows (two of three), for even keys, if they are longer."""
    key = F.col("c_custkey")
    link = F.concat(F.lit("https://a/"), key.cast("string"))
    rows = t(spark, sf, "customer").select("c_custkey", link.alias("link"), _one_of(["web-scraper", "rss", "web-scraper"], key).alias("adapter"), F.concat(F.lit("short "), key.cast("string")).alias("summary"))
    said = F.when(key % 5 == 0, F.lit("<p>Too short</p>")).otherwise(F.concat(F.lit("<article><p>No</p><p>The fetched <b>article</b> of "), key.cast("string"), F.lit(" has a paragraph that is long enough.</p></article>")))
    got = t(spark, sf, "customer").where("c_custkey % 2 = 0").select(link.alias("url"), said.alias("html"))
    return flows.enriched(rows, got).select("c_custkey", "summary")


ENVELOPES = [
    (200, """{"model":"m1","choices":[{"finish_reason":"stop","message":{"content":"{\\"n\\":{id}}"}}],"usage":{"prompt_tokens":{id},"completion_tokens":7}}"""),
    (200, """{"choices":[{"message":{"content":"[{id}]"}}],"usage":{"prompt_tokens":1,"completion_tokens":1,"total_tokens":9}}"""),
    (200, """{"choices":[{"finish_reason":"length","message":{"content":"{}"}}]}"""),
    (200, """{"choices":[{"message":{"content":"no json {id}"}}]}"""),
    (200, """{"choices":[]}"""),
    (429, """{"error":{"type":"rate_limit_error"}}"""),
    (503, """<html>"""),
    (None, None),
]


@query(
    """select s_suppkey, case s_suppkey % 8 when 0 then '{"n":' || s_suppkey || '}' when 1 then '[' || s_suppkey || ']' end as response,
    [null, null, 'truncated_response', 'invalid_json', 'invalid_response', 'rate_limit_error', 'http_503', 'network_error'][s_suppkey % 8 + 1] as error, case s_suppkey % 8 when 0 then 'm1' else 'm0' end as model,
    cast(case s_suppkey % 8 when 0 then s_suppkey when 1 then 1 else 0 end as bigint) as prompt_tokens, cast(case s_suppkey % 8 when 0 then s_suppkey + 7 when 1 then 9 else 0 end as bigint) as total_tokens from supplier"""
)
def model_replies(spark, sf):
    return _answers(spark, sf).drop("completion_tokens")


def _answers(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    body = F.replace(_one_of([e[1] for e in ENVELOPES], key), F.lit("{id}"), key.cast("string"))
    status = _one_of([e[0] for e in ENVELOPES], key).cast("int")
    return t(spark, sf, "supplier").select("s_suppkey", writer.answer(status, body, "m0").alias("a")).select("s_suppkey", "a.*")


@query("select case s_suppkey % 8 when 0 then 'm1' else 'm0' end as model, count(*) as asked, count(*) filter (s_suppkey % 8 < 2) as answered, cast(sum(case s_suppkey % 8 when 0 then s_suppkey when 1 then 1 else 0 end) as bigint) as prompt_tokens, cast(sum(case s_suppkey % 8 when 0 then 7 when 1 then 1 else 0 end) as bigint) as completion_tokens, cast(sum(case s_suppkey % 8 when 0 then s_suppkey + 7 when 1 then 9 else 0 end) as bigint) as total_tokens from supplier group by 1")
def model_usage(spark, sf):
    return writer.usage(_answers(spark, sf))


@query(
    """with o as (select o_orderkey as seq, 'title ' || o_orderkey as title, cast(o_orderkey % 101 as integer) as conf, cast(o_custkey % 101 as integer) as heat, length(o_orderpriority) * 8 as n from orders)
    select seq, ['值不值得写','看点回顾','数字背后','技术拆解','本地影响','现场观察'][seq % 6 + 1] as frame, '2024-01-31-子推送-' || substr(lower(to_hex(abs(case when h >= 2147483648 then h - 4294967296 else h end))), 1, 8) || '.md' as filename
    from (select *, list_reduce(list_prepend(cast(0 as bigint), list_transform(string_split(title, ''), lambda x: cast(ord(x) as bigint))), lambda a, x: (a * 31 + x) & 4294967295) as h from o where conf >= 60 and heat >= 60 and n >= 60 order by conf + heat desc, seq limit 25)"""
)
def push_names(spark, sf):
    """The best 25 orders as rows of their own, with frames by kind and names of files by hash."""
    key = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select(
        key.alias("seq"), F.concat(F.lit("title "), key.cast("string")).alias("title"), F.lit("").alias("externalId"), (key % 101).alias("confidence"), (F.col("o_custkey") % 101).alias("heat"),
        F.repeat("o_orderpriority", F.lit(8)).alias("summary"), _one_of(["new-models", "racing", "industry", "tech", "local-market", "culture"], key).alias("category"), F.lit("2024-01-31").alias("day"),
    )
    return flows.pushes(rows, 25).select("seq", "frame", "filename")

"""Each operator on the driver's tables, with the same in SQL. Tables stand in for the entities: pages for fetched
pages, orders and events for signals, customers and suppliers for sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigweave.functions import dates, scoring, text, urls
from sigweave.operators import cluster, dedup, render, select
from sigweave.sources import markdown
from sigweave.sources import pages as page_source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF = "2024-01-31 00:00:00"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


STRIP = "trim(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '&[a-z]+;', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"select page_id, {STRIP.format(chr(34) + 'h' + chr(34))} as heading from (select page_id, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) as h from pages)")
def page_heading(spark, sf):
    return t(spark, sf, "pages").select("page_id", page_source.heading(F.col("html"))["title"].alias("heading"))


@query(f"select page_id, {STRIP.format('html')} as body from pages")
def page_text(spark, sf):
    return t(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


@query(
    """with flat as (select page_id, unnest(regexp_extract_all(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), '(?is)<p[^>]*>(.*?)</p>', 1)) as p, generate_subscripts(regexp_extract_all(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), '(?is)<p[^>]*>(.*?)</p>', 1), 1) as k from pages),
    clean as (select page_id, k, """
    + STRIP.format("p")
    + """ as p from flat), long as (select *, coalesce(sum(length(p)) over (partition by page_id order by k rows between unbounded preceding and 1 preceding), 0) as n from clean where length(p) >= 40),
    made as (select page_id, substr(string_agg(p, ' ' order by k), 1, 1500) as excerpt from long where n < 1500 group by page_id) select page_id, excerpt from pages left join made using (page_id)"""
)
def page_excerpt(spark, sf):
    return t(spark, sf, "pages").select("page_id", page_source.excerpt(F.col("html")).alias("excerpt"))


@query("select page_id, length(replace(replace(replace(replace(replace(replace(html, '&amp;', '&'), '&quot;', '\"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' ')) as size from pages")
def page_entity_decode(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.length(text.decode_entities(F.col("html"))).cast("long").alias("size"))


@query(
    f"""select url, url || 's/1' as link, replace(title, '&#39;', chr(39)) as title, 1 as tier from (select 'https://h' || page_id || '.example.com/' as url, {STRIP.format("regexp_extract(html, '(?is)<article[^>]*>.*?<h1[^>]*>(.*?)</h1>', 1)")} as title from pages)
    where length(replace(title, '&#39;', chr(39))) >= 15"""
)
def page_signals(spark, sf):
    """Pages as fetched from a host each, their articles' headings as links: the given ones have none."""
    url = F.concat(F.lit("https://h"), F.col("page_id").cast("string"), F.lit(".example.com/"))
    rows = t(spark, sf, "pages").select(url.alias("url"), F.replace("html", F.lit("<article><h1>"), F.lit('<article><h1><a href="/s/1">')).alias("html"))
    return page_source.signals(rows, F.lit(AS_OF).cast("timestamp")).select("url", "link", "title", "tier")


@query("select page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) as host from pages")
def url_host(spark, sf):
    return t(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"))


@query(
    """with p as (select page_id, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) as s, lower(regexp_extract(url, '://([^/?#]*)', 1)) as a, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) as path, regexp_extract(url, '\\?([^#]*)', 1) as q from pages),
    k as (select page_id, s || '://' || a || case when regexp_replace(path, '/+$', '') = '' then '/' else regexp_replace(path, '/+$', '') end as base,
      array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' and not (lower(split_part(x, '=', 1)) in ('fbclid','gclid','igshid','mc_cid','mc_eid','ref','source','spm','utm_campaign','utm_content','utm_medium','utm_source','utm_term')))), '&') as rest from p)
    select page_id, base || case when rest <> '' then '?' || rest else '' end as canonical from k"""
)
def url_canonical(spark, sf):
    return t(spark, sf, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query("select page_id, string_split(lower(regexp_extract(url, '://([^/?#]*)', 1)), '.')[-2] as label from pages")
def url_brand_label(spark, sf):
    return t(spark, sf, "pages").select("page_id", urls.core_label(urls.host(F.col("url"))).alias("label"))


TOKENS = "list_distinct(list_filter(string_split(regexp_replace(lower(string_split(text, chr(10))[1]), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) > 1 and not (x in ('a','an','and','for','in','of','on','the','to','with','new','news'))))"


def _titles(spark, sf):
    title = F.regexp_replace(F.lower(F.split("text", "\n")[0]), "[^a-z0-9]+", " ")
    return t(spark, sf, "documents").select("doc_id", "source", title.alias("title"))


@query(f"select doc_id, array_to_string(list_sort({TOKENS}), ' ') as tokens from documents")
def title_tokens(spark, sf):
    return _titles(spark, sf).select("doc_id", F.array_join(F.array_sort(text.title_tokens(F.col("title"), compose=False)), " ").alias("tokens"))


@query(
    f"""with d as (select doc_id, {TOKENS} as k, row_number() over (order by doc_id) as n from documents)
    select a.doc_id, case when len(a.k) = 0 or len(b.k) = 0 then 0.0 else len(list_intersect(a.k, b.k)) / cast(len(a.k) + len(b.k) - len(list_intersect(a.k, b.k)) as double) end as similarity from d a join d b on b.n = a.n + 1"""
)
def title_jaccard_next(spark, sf):
    d = _titles(spark, sf).select("doc_id", text.title_tokens(F.col("title"), compose=False).alias("k"))
    nxt = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("k").alias("other"))
    return d.join(nxt, "doc_id").select("doc_id", text.jaccard(F.col("k"), F.col("other")).alias("similarity"))


def _signals(spark, sf):
    """Documents as signals: first line as title, an hour apart."""
    d = t(spark, sf, "documents")
    title = F.split("text", "\n")[0]
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 3600)
    return d.select(F.col("doc_id").alias("seq"), F.col("source").alias("source_slug"), F.col("lang").alias("category"), title.alias("title"), ts.alias("ts")).withColumn("fp", F.lit(None).cast("string"))


@query(
    f"""with d as (select doc_id, {TOKENS.replace('[^a-z0-9]', '[^a-z0-9一-鿿]')} as k from documents), x as (select a.doc_id as a, b.doc_id as b, len(list_intersect(a.k, b.k)) as n, len(a.k) as p, len(b.k) as q from d a join d b on a.doc_id < b.doc_id and b.doc_id - a.doc_id <= 96)
    select a, b from x where p > 0 and q > 0 and n / cast(p + q - n as double) >= 0.46"""
)
def sim_edges_window(spark, sf):
    rows = _signals(spark, sf).withColumn("tokens", text.title_tokens(F.col("title"), compose=False))
    return cluster.links(rows)


@query(
    f"""with recursive d as (select doc_id, source, {TOKENS} as k from documents), x as (select a.doc_id as a, b.doc_id as b, len(list_intersect(a.k, b.k)) as n, len(a.k) as p, len(b.k) as q from d a join d b on a.doc_id < b.doc_id and b.doc_id - a.doc_id <= 96),
    e as (select a, b from x where p > 0 and q > 0 and n / cast(p + q - n as double) >= 0.46), r(seq, low) as (select doc_id, doc_id from d union select e.b, r.low from r join e on e.a = r.seq),
    c as (select seq, min(low) as cluster_id from r group by seq), g as (select cluster_id, count(distinct source) as cluster_size from c join d on doc_id = seq group by 1) select seq, cluster_id, cluster_size from c join g using (cluster_id)"""
)
def event_clusters(spark, sf):
    rows = _signals(spark, sf).withColumn("tokens", text.title_tokens(F.col("title"), compose=False))
    return cluster.clustered(rows).select("seq", "cluster_id", "cluster_size")


@query(
    """with recursive d as (select doc_id, source, lang, (doc_id * 37) % 3001 as h from documents),
    e as (select a.doc_id as a, b.doc_id as b from d a join d b on a.source = b.source and a.lang = b.lang and a.doc_id < b.doc_id and abs(a.h - b.h) <= 504),
    r(seq, low) as (select doc_id, doc_id from d union select e.b, r.low from r join e on e.a = r.seq), c as (select seq, min(low) as cluster_id from r group by seq),
    g as (select cluster_id, count(distinct source) as cluster_size from c join d on doc_id = seq group by 1) select seq, cluster_id, cluster_size from c join g using (cluster_id)"""
)
def event_clusters_by_name(spark, sf):
    """Documents with their sources as fingerprints, at hours out of order."""
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("doc_id") * 37) % 3001 * 3600)
    rows = t(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("source").alias("source_slug"), F.col("lang").alias("category"), ts.alias("ts"), F.col("source").alias("fp"), F.array().cast("array<string>").alias("tokens"))
    return cluster.clustered(rows).select("seq", "cluster_id", "cluster_size")


@query("select s_suppkey, cast(greatest(0, least(100, floor((s_suppkey % 100) * 0.6::double + case when s_nationkey % 2 = 0 then 20 else 0 end + least(s_suppkey % 6, 3) * 10 + 0.5))) as integer) as confidence from supplier")
def confidence_score(spark, sf):
    s = t(spark, sf, "supplier")
    return s.select("s_suppkey", scoring.confidence(F.col("s_suppkey") % 100, F.col("s_nationkey") % 2 == 0, F.col("s_suppkey") % 6 + 1).alias("confidence"))




@query(
    """select event_id, cast(greatest(0, least(100, 40 + least(user_id % 5, 3) * 15 + case when value is null then 0 when epoch(timestamp '2024-01-31') - epoch(ts) <= 86400 then 15 when epoch(timestamp '2024-01-31') - epoch(ts) <= 259200 then 8 else 0 end)) as integer) as heat from events"""
)
def heat_score(spark, sf):
    e = t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    hours = (F.unix_micros(F.lit(AS_OF).cast("timestamp")) - F.unix_micros("ts")) / 3.6e9
    return e.select("event_id", scoring.heat(F.col("event_type"), F.col("user_id") % 5 + 1, F.lit(""), hours, F.col("value").isNotNull()).alias("heat"))


KEYS = ["debut", "discontinued", "recall", "record", "announce", "controversy"]


@query("select doc_id, cast(" + " + ".join(f"case when regexp_matches(text, '(?i){k}') then 1 else 0 end" for k in KEYS) + " as integer) as hits, case when regexp_matches(text, '(?i)calendar|regulation|championship rules|broadcast rights|postponed|canceled|cancelled') then 30 when regexp_matches(text, '(?i)marquez') then 15 else 0 end as scope from documents")
def keyword_hits(spark, sf):
    return t(spark, sf, "documents").select("doc_id", scoring.keyword_hits(F.col("text")).alias("hits"), scoring.scope(F.col("text")).alias("scope"))


@query("select o_orderpriority, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as r from orders) where r = 1")
def leader_per_group(spark, sf):
    return select.best_per(t(spark, sf, "orders"), "o_orderpriority", "o_totalprice", "o_orderkey").select("o_orderpriority", "o_orderkey", "o_totalprice")


@query("select o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_orderpriority order by floor(o_totalprice / 10000) desc, o_orderkey) as r, min(o_orderkey) over (partition by o_orderpriority) as f from orders) where r = 1 order by floor(o_totalprice / 10000) desc, f limit 3")
def top3_of_leaders(spark, sf):
    o = t(spark, sf, "orders").withColumn("score", F.floor(F.col("o_totalprice") / 10000))
    return select.top_leaders(o, "o_orderpriority", "score", 3, "o_orderkey").select("o_orderkey", "o_orderpriority")


@query("select cluster_id, seq, score from (select l_orderkey as cluster_id, l_linenumber as seq, floor(l_extendedprice) as score, row_number() over (partition by l_orderkey order by floor(l_extendedprice) desc, l_linenumber, l_partkey, l_suppkey) as r from lineitem) where r = 1 order by score desc, cluster_id limit 10")
def cluster_representative(spark, sf):
    rows = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("cluster_id"), F.col("l_linenumber").alias("seq"), F.floor("l_extendedprice").cast("double").alias("score"))
    return select.representatives(rows, "score", 10)


@query("select o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as r from orders) where r <= 10")
def topk_per_category(spark, sf):
    return select.top_per(t(spark, sf, "orders"), "o_orderpriority", "o_totalprice", 10, "o_orderkey").select("o_orderkey", "o_orderpriority")


@query("select event_id, event_type from (select *, row_number() over (partition by event_type order by event_id) as r from events) where r <= 30")
def take_per_source(spark, sf):
    return select.take(t(spark, sf, "events"), "event_type", 30, "event_id").select("event_id", "event_type")


@query("select o_orderkey, o_totalprice from orders where o_orderkey % 101 >= 60 and o_custkey % 101 >= 60 and length(o_orderpriority) * 8 >= 60 order by o_orderkey % 101 + o_custkey % 101 desc, o_orderkey limit 2")
def candidates_threshold_topk(spark, sf):
    o = t(spark, sf, "orders").select("*", F.col("o_orderkey").alias("seq"), (F.col("o_orderkey") % 101).alias("confidence"), (F.col("o_custkey") % 101).alias("heat"), F.repeat("o_orderpriority", F.lit(8)).alias("summary"))
    return select.candidates(o).select("o_orderkey", "o_totalprice")


@query("select event_type, user_id, event_id from (select *, row_number() over (partition by event_type, user_id order by ts, event_id) as r from events) where r = 1")
def dedup_first_wins(spark, sf):
    return dedup.first_wins(t(spark, sf, "events"), ["event_type", "user_id"], ["ts", "event_id"]).select("event_type", "user_id", "event_id")


@query("select doc_id from (select doc_id, count(*) over (partition by source, lower(string_split(text, chr(10))[1])) as n from documents) where n < 2")
def title_repeat_drop(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "source", F.split("text", "\n")[0].alias("title"))
    return dedup.drop_repeated_titles(d, "source", "title").select("doc_id")


#: Events as rows of runs: before CUT the earlier ones. A key is seen again or not.
CUT = "2024-01-16 00:00:00"
KEYED = f"select event_id, event_type as source_slug, user_id || '/' || event_id % 13 as dedup_key, ts, ts >= timestamp '{CUT}' as late from events"


def _state(spark, sf):
    e = t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    key = F.concat(F.col("user_id").cast("string"), F.lit("/"), (F.col("event_id") % 13).cast("string"))
    return e.select("event_id", F.col("event_type").alias("source_slug"), key.alias("dedup_key"), "ts", (F.col("ts") >= F.lit(CUT).cast("timestamp")).alias("late"))


@query(f"with e as ({KEYED}) select source_slug, dedup_key, min(event_id) as event_id from e where late and not exists (select 1 from e o where not o.late and o.source_slug = e.source_slug and o.dedup_key = e.dedup_key) group by all")
def new_keys_anti_join(spark, sf):
    e = _state(spark, sf)
    old = e.where("not late").groupBy("source_slug", "dedup_key").agg(F.min("ts").alias("first_seen"))
    return dedup.new_rows(e.where("late"), old, ["event_id"]).select("source_slug", "dedup_key", "event_id")


@query(f"""with e as ({KEYED}), s as (select source_slug, dedup_key, min(ts) as first_seen from e where not late group by all),
    n as (select source_slug, dedup_key, timestamp '2024-02-07' as first_seen from (select distinct source_slug, dedup_key from e where late except select source_slug, dedup_key from s))
    select source_slug, dedup_key, epoch_us(first_seen) as first_seen_us from (from s union all from n) where first_seen >= timestamp '2024-02-07' - interval 30 days""")
def state_prune(spark, sf):
    """Keys of the earlier runs, some of them past their time by the last one, and the last one's."""
    e, as_of = _state(spark, sf), F.lit("2024-02-07 00:00:00").cast("timestamp")
    state = e.where("not late").groupBy("source_slug", "dedup_key").agg(F.min("ts").alias("first_seen"))
    out = dedup.next_state(state, dedup.new_rows(e.where("late"), state, ["event_id"]), as_of)
    return out.select("source_slug", "dedup_key", F.unix_micros("first_seen").alias("first_seen_us"))


@query("with d as (select *, cast(ts as date) as day from events) select event_id, user_id from d where day between date '2024-01-10' - 3 and date '2024-01-10' - 1")
def lookback_context(spark, sf):
    from sigweave.sources import snapshots

    e = t(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return snapshots.lookback(e, F.lit("2024-01-10").cast("date")).select("event_id", "user_id")


@query("select event_id, cast(cast(date_trunc('week', ts) as date) as varchar) as monday from events where cast(ts as date) between date '2024-01-08' and date '2024-01-14'")
def week_window(spark, sf):
    from sigweave.sources import snapshots

    e = t(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return snapshots.week(e, F.lit("2024-01-08").cast("date")).select("event_id", dates.monday_of(F.col("day")).cast("string").alias("monday"))


@query("select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as is_top from customer")
def overview_semi_remaining_anti(spark, sf):
    c = t(spark, sf, "customer").withColumnRenamed("c_custkey", "index")
    top, rest = select.split_top(c, t(spark, sf, "orders").select(F.col("o_custkey").alias("index")).distinct())
    return top.select(F.col("index").alias("c_custkey"), F.lit(True).alias("is_top")).union(rest.select("index", F.lit(False)))


@query("with items as (select o_custkey as index, max(o_orderkey) as k from orders where o_orderkey % 3 > 0 group by 1) select c_custkey, c_name, o_totalprice as body from customer join items on c_custkey = index join orders on o_orderkey = k")
def positional_join(spark, sf):
    """Orders as written items, customers as the rows that they are about: the last of an index wins."""
    items = t(spark, sf, "orders").where("o_orderkey % 3 > 0").select(F.col("o_custkey").alias("index"), F.col("o_orderkey").alias("pos"), F.col("o_totalprice").alias("body"))
    rows = t(spark, sf, "customer").select(F.col("c_custkey").alias("index"), "c_name")
    return select.by_index(items, rows).select(F.col("index").alias("c_custkey"), "c_name", "body")


@query(f"with e as ({KEYED}), n as (select source_slug, count(*) as n from (select distinct source_slug, dedup_key from e where late except select source_slug, dedup_key from e where not late) group by 1) select source_slug, count(*) as fetched, coalesce(max(n.n), 0) as new from e left join n using (source_slug) where late group by 1")
def run_report(spark, sf):
    e = _state(spark, sf)
    fresh = dedup.new_rows(e.where("late"), e.where("not late").select("source_slug", "dedup_key").distinct(), ["event_id"])
    return dedup.run_report(e.where("late"), fresh).drop("error")


@query("select o_orderkey, case when o_orderpriority = '1-URGENT' then '未知' else strftime(o_orderdate, '%Y-%m-%d') end as label, month(o_orderdate) || '月' || day(o_orderdate) || '日 · 周' || substr('日一二三四五六', dayofweek(o_orderdate) + 1, 1) as header from orders")
def date_labels(spark, sf):
    o, ts = t(spark, sf, "orders"), F.col("o_orderdate").cast("timestamp")
    return o.select("o_orderkey", dates.date_label(ts, F.col("o_orderpriority") == "1-URGENT").alias("label"), dates.day_header(F.to_date(ts)).alias("header"))


@query(
    """with h as (select p_partkey, list_reduce(list_prepend(cast(0 as bigint), list_transform(string_split(p_name, ''), lambda x: cast(ord(x) as bigint))), lambda a, x: (a * 31 + x) & 4294967295) as h from part)
    select p_partkey, substr(lower(to_hex(abs(case when h >= 2147483648 then h - 4294967296 else h end))), 1, 8) as short from h"""
)
def hash_short(spark, sf):
    return t(spark, sf, "part").select("p_partkey", text.short_hash(F.col("p_name")).alias("short"))


@query("with x as (select page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) as host, length(html) as size, row_number() over (partition by lower(regexp_extract(url, '://([^/?#]*)', 1)) order by length(html) desc, page_id) as r from pages) select host, page_id, size from x where r = 1 order by size desc, page_id limit 10")
def flagship_hosts(spark, sf):
    """The longest page of each host, the ten longest of these."""
    p = t(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"), F.length("html").cast("long").alias("size"))
    return select.best_per(p, "host", "size", "page_id").orderBy(F.col("size").desc(), "page_id").limit(10).select("host", "page_id", "size")




CATS = "['racing','new-models','tech','industry','local-market','culture']"
NL = "chr(10) || chr(10)"


def _days(spark, sf):
    """Suppliers as the rows of days of 20 rows."""
    w = Window.partitionBy("day").orderBy("s_suppkey")
    s = t(spark, sf, "supplier").select("s_suppkey", "s_name", F.floor(F.col("s_suppkey") / 20).cast("string").alias("day"))
    cats = F.array(*[F.lit(c) for c in render.SECTIONS])
    s = s.withColumn("index", F.row_number().over(w)).withColumn("category", F.get(cats, (F.col("s_suppkey") % 6).cast("int")))
    return s.withColumn("is_top", F.col("index") == 1).withColumn("is_leader", F.col("index") <= 3).withColumn("url", F.concat(F.lit("https://x/"), F.col("s_suppkey").cast("string")))


SUPPLIED = f"with s as (select s_suppkey as k, s_name, cast(s_suppkey // 20 as varchar) as day, cast(row_number() over (partition by s_suppkey // 20 order by s_suppkey) as integer) as i, {CATS}[s_suppkey % 6 + 1] as cat from supplier)"


@query(
    SUPPLIED + """ select day, string_agg(i || '. ' || case when i = 1 then '【今日头条】' when i <= 3 then '【本方向今日代表】' else '' end || '【' || cat || '】' || s_name || chr(10) || '   来源：' || s_name || '　时间：未知' || chr(10) || '   摘要：' || substr(repeat(s_name, 100), 1, 800), chr(10) || chr(10) order by i) as prompt from s group by day"""
)
def prompt_text(spark, sf):
    line = render.prompt_line(F.col("index"), F.col("category"), F.col("s_name"), F.col("s_name"), dates.date_label(F.lit(None).cast("timestamp"), F.lit(True)), F.repeat("s_name", F.lit(100)), render.mark_of(F.col("is_top"), F.col("is_leader")))
    return render.joined(_days(spark, sf), "day", ["index"], line, "\n\n").withColumnRenamed("text", "prompt")


@query(
    SUPPLIED + f""", b as (select *, i = 1 as top, case when i = 1 then '今日头条' else ['赛事赛果','全球新车发布','技术工程解读','产业商业动态','本地车市','骑行文化车展活动'][k % 6 + 1] end as section, case when i = 1 then 0 else k % 6 + 1 end as place from s where k % 5 <> 0),
    n as (select *, row_number() over (partition by day, section order by case when top then 0 else -(k % 17) end, i) as r from b),
    body as (select day, string_agg(case when r = 1 then '## ' || section || {NL} else '' end || '**h ' || s_name || '**' || {NL} || 'b' || k || '（[' || s_name || '](https://x/' || k || ')）' || {NL}, '' order by place, r) as body from n where top or r <= 10 group by day),
    heads as (select day, string_agg('- o' || i || chr(10), '' order by i) as lines from b where i <= 3 group by day)
    select d.day, regexp_replace('# Day ' || d.day || {NL} || '> ' || d.day || {NL} || '## 今日热点导览' || {NL} || coalesce(lines, '') || chr(10) || coalesce(body, ''), '\\s+$', '') || chr(10) as markdown from (select distinct day from s) d left join body using (day) left join heads using (day)"""
)
def daily_markdown(spark, sf):
    """Responses as a model would write them, as JSON, checked and rendered."""
    rows = _days(spark, sf).withColumn("score", F.col("s_suppkey") % 17).withColumn("source_name", F.col("s_name"))
    item = F.struct("index", F.concat(F.lit("h "), "s_name").alias("heading"), F.concat(F.lit("b"), F.col("s_suppkey").cast("string")).alias("body"), "category", (F.col("s_suppkey") % 5 != 0).alias("relevant"))
    listed = rows.groupBy("day").agg(F.sort_array(F.collect_list(item)).alias("items"))
    overview = F.transform(F.slice("items", 1, 10), lambda i: F.struct(i["index"].alias("index"), F.concat(F.lit("o"), i["index"].cast("string")).alias("text")))
    said = listed.select("day", F.to_json(F.struct(F.concat(F.lit("Day "), "day").alias("headline"), overview.alias("overview"), "items")).alias("response"))
    return render.daily(said.select("day", render.checked_daily(F.col("response")).alias("r")), rows)


@query("select s_suppkey, '# ' || s_name || chr(10) || chr(10) || 'hook' || chr(10) || chr(10) || 'body' || chr(10) || chr(10) || 'verdict' || chr(10) || chr(10) || 'q' || chr(10) || chr(10) || '（[' || s_name || '](https://x/' || s_suppkey || ')）' || chr(10) as markdown from supplier")
def push_markdown(spark, sf):
    r = render.checked_push(F.lit('{"hook":"hook","body":"body","verdict":"verdict","closingQuestion":"q"}'))
    return _days(spark, sf).select("s_suppkey", render.push(r, F.col("s_name"), F.col("s_name"), F.col("url")).alias("markdown"))


@query(f"select doc_id, case when regexp_matches(text, '(?i)召回|事故|故障|漏油|起火|安全隐患|recall|crash|fire hazard|malfunction') then '利益相关' else ['看点回顾','值不值得写','技术拆解','数字背后','本地影响','现场观察','其他'][doc_id % 7 + 1] end as frame from documents")
def framework_choice(spark, sf):
    kinds = F.array(*[F.lit(c) for c in [*render.SECTIONS, "other"]])
    return t(spark, sf, "documents").select("doc_id", render.frame_of(F.lit(""), F.col("text"), F.get(kinds, (F.col("doc_id") % 7).cast("int")), "其他").alias("frame"))


@query("select c_custkey, 'T ' || c_name as title, c_mktsegment as date_range, c_name || ' brief' as briefing, cast(c_custkey % 4 as integer) as item_count from customer")
def markdown_meta(spark, sf):
    c = F.concat(F.lit("# T "), "c_name", F.lit("\n\n> "), "c_mktsegment", F.lit("\n\n"), "c_name", F.lit(" brief\n\n"), F.repeat(F.lit("**item**\n\ntext **not one**\n\n"), (F.col("c_custkey") % 4).cast("int")))
    rows = t(spark, sf, "customer").select("c_custkey", c.alias("c"))
    c = F.col("c")
    return rows.select("c_custkey", markdown.title(c).alias("title"), markdown.date_range(c).alias("date_range"), markdown.briefing(c).alias("briefing"), markdown.item_count(c).alias("item_count"))


@query("select doc_id, sha256(text) as sha from documents where text is not null")
def charset_decode(spark, sf):
    rows = t(spark, sf, "documents").where("text is not null")
    return rows.select("doc_id", F.sha2(text.decode_body(F.encode("text", "UTF-8"), F.lit("text/html; charset=utf-8")), 256).alias("sha"))


from . import made  # noqa: E402, F401  registers its queries

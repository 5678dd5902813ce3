"""Prompts, checked responses and Markdown. Names and links come from collected rows, never from a response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigweave.functions import dates

# Titles of the sections of categories, in order of display.
SECTIONS = {"racing": "赛事赛果", "new-models": "全球新车发布", "tech": "技术工程解读", "industry": "产业商业动态", "local-market": "本地车市", "culture": "骑行文化车展活动"}
# Titles of the other sections, marks of rows in a prompt.
HIGHLIGHTS, TOP, WEEKLY = "今日热点导览", "今日头条", "上周十大热点"
TOP_MARK, LEADER_MARK = "【今日头条】", "【本方向今日代表】"
# Names of the frames of a push by category, the frame and the pattern of incidents.
FRAMES = {"new-models": "值不值得写", "racing": "看点回顾", "industry": "数字背后", "tech": "技术拆解", "local-market": "本地影响", "culture": "现场观察"}
INCIDENT_FRAME, INCIDENT = "利益相关", "召回|事故|故障|漏油|起火|安全隐患|recall|crash|fire hazard|malfunction"
PER_SECTION, SUMMARY = 10, 800

_ITEM = "index: int, heading: string, body: string"
DAILY = f"headline string, overview array<struct<index: int, text: string>>, items array<struct<{_ITEM}, category: string, relevant: boolean>>"
WEEK = f"headline string, briefing string, items array<struct<{_ITEM}>>"
PUSH = "hook string, body string, verdict string, closingQuestion string"


def _filled(*cs: Column) -> Column:
    out = F.lit(True)
    for c in cs:
        out = out & (F.length(c) > 0)
    return out


def _items(r: Column) -> Column:
    return (F.size(r["items"]) >= 1) & F.forall(r["items"], lambda i: (i["index"] > 0) & _filled(i["heading"], i["body"]))


def checked_daily(c: Column) -> Column:
    """The parsed response, null if a part is missing, empty or out of range."""
    r = F.from_json(c, DAILY)
    lines = F.size(r["overview"]).between(1, 10) & F.forall(r["overview"], lambda o: (o["index"] > 0) & _filled(o["text"]))
    kinds = F.forall(r["items"], lambda i: i["category"].isin(list(SECTIONS)) & i["relevant"].isNotNull())
    return F.when(F.coalesce(_filled(r["headline"]) & lines & _items(r) & kinds, F.lit(False)), r)


def checked_weekly(c: Column) -> Column:
    r = F.from_json(c, WEEK)
    return F.when(F.coalesce(_filled(r["headline"], r["briefing"]) & _items(r), F.lit(False)), r)


def checked_push(c: Column) -> Column:
    r = F.from_json(c, PUSH)
    return F.when(F.coalesce(_filled(r["hook"], r["body"], r["verdict"], r["closingQuestion"]), F.lit(False)), r)


def frame_of(title: Column, summary: Column, category: Column, other: str = "") -> Column:
    """The frame of a push: incidents have their own, whatever the category."""
    names = F.create_map(*[F.lit(x) for pair in FRAMES.items() for x in pair])
    incident = F.concat_ws(" ", title, summary).rlike(f"(?i){INCIDENT}")
    return F.when(incident, F.lit(INCIDENT_FRAME)).otherwise(F.coalesce(names[category], F.lit(other)))


def prompt_line(index: Column, category: Column, title: Column, source: Column, label: Column, summary: Column, mark: Column | None = None) -> Column:
    parts = [index.cast("string"), F.lit(". "), mark if mark is not None else F.lit(""), F.lit("【"), category, F.lit("】"), title, F.lit("\n   来源："), source, F.lit("　时间："), label, F.lit("\n   摘要："), F.substring(summary, 1, SUMMARY)]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def mark_of(is_top: Column, is_leader: Column) -> Column:
    return F.when(is_top, F.lit(TOP_MARK)).when(is_leader, F.lit(LEADER_MARK)).otherwise(F.lit(""))


def joined(rows: DataFrame, by: str, order: list[str], part: Column, between: str) -> DataFrame:
    """by, text: the parts of each group in order. A group is one document."""
    listed = F.sort_array(F.collect_list(F.struct(*order, part.alias("part"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(listed, lambda x: x["part"]), between).alias("text"))


def _closed(c: Column) -> Column:
    return F.concat(F.regexp_replace(c, r"\s+$", ""), F.lit("\n"))


def _cite(source: Column, url: Column) -> Column:
    return F.when(url.isNull(), F.lit("")).otherwise(F.concat(F.lit("（["), F.coalesce(source, F.lit("")), F.lit("]("), url, F.lit(")）")))


def daily(responses: DataFrame, rows: DataFrame) -> DataFrame:
    """day, markdown. responses: day, r as checked_daily gives it. rows: day, index, source_name, url, score,
    is_top, is_leader. Items that the response calls irrelevant go; a section has PER_SECTION items at most."""
    rows = rows.select("day", "index", "source_name", "url", "score", "is_top", "is_leader")
    items = responses.select("day", F.posexplode("r.items").alias("pos", "i")).where("i.relevant").select("day", "pos", "i.*").drop("relevant")
    known = items.join(rows, ["day", "index"], "left").withColumn("top", F.coalesce("is_top", F.lit(False)))
    known = known.withColumn("section", F.when(F.col("top"), F.lit(TOP)).otherwise(F.col("category")))
    group = Window.partitionBy("day", "top", "section")
    rank = group.orderBy(F.when(F.col("top"), F.lit(0)).otherwise(-F.coalesce("score", F.lit(0))), "pos")
    titles = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    place = F.when(F.col("top"), F.lit(0)).otherwise(F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("category")), F.lit(0)), F.lit(99)))
    block = F.concat(F.lit("**"), "heading", F.lit("**\n\n"), "body", _cite(F.col("source_name"), F.col("url")), F.lit("\n\n"))
    head = F.concat(F.lit("## "), F.coalesce(titles[F.col("section")], F.col("section")), F.lit("\n\n"))
    placed = known.withColumn("n", F.row_number().over(rank)).withColumn("first", F.min("pos").over(group)).withColumn("place", place)
    placed = placed.where(F.col("top") | (F.col("n") <= PER_SECTION))
    body = joined(placed, "day", ["place", "first", "n"], F.concat(F.when(F.col("n") == 1, head).otherwise(F.lit("")), block), "").withColumnRenamed("text", "body")
    lines = responses.select("day", F.posexplode("r.overview").alias("pos", "o")).select("day", "pos", F.col("o.index").alias("index"), F.col("o.text").alias("line"))
    lines = lines.join(rows.where("is_leader"), ["day", "index"], "left_semi").join(items, ["day", "index"], "left_semi")
    bullets = joined(lines, "day", ["pos"], F.concat(F.lit("- "), "line", F.lit("\n")), "").withColumnRenamed("text", "bullets")
    whole = responses.where("r is not null").join(bullets, "day", "left").join(body, "day", "left")
    text = F.concat(F.lit("# "), "r.headline", F.lit("\n\n> "), F.col("day").cast("string"), F.lit(f"\n\n## {HIGHLIGHTS}\n\n"), F.coalesce("bullets", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")))
    return whole.select("day", _closed(text).alias("markdown"))


def weekly(responses: DataFrame, rows: DataFrame) -> DataFrame:
    """monday, markdown. responses: monday, r as checked_weekly gives it. rows: monday, index, source_name, url.
    Of items with one index the last serves; rows without an item go."""
    items = responses.select("monday", F.posexplode("r.items").alias("pos", "i"))
    last = items.groupBy("monday", F.col("i.index").alias("index")).agg(F.max_by("i", "pos").alias("i"))
    told = rows.select("monday", "index", "source_name", "url").join(last, ["monday", "index"])
    block = F.concat(F.lit("**"), F.col("index").cast("string"), F.lit(". "), "i.heading", F.lit("**\n\n"), "i.body", _cite(F.col("source_name"), F.col("url")), F.lit("\n\n"))
    body = joined(told, "monday", ["index"], block, "").withColumnRenamed("text", "body")
    monday = F.col("monday").cast("date")
    text = F.concat(F.lit("# "), "r.headline", F.lit("\n\n> "), dates.month_day(monday), F.lit(" – "), dates.month_day(F.date_add(monday, 6)), F.lit("（上周）\n\n"), "r.briefing", F.lit(f"\n\n## {WEEKLY}\n\n"), F.coalesce("body", F.lit("")))
    return responses.where("r is not null").join(body, "monday", "left").select("monday", _closed(text).alias("markdown"))


def push(r: Column, title: Column, source: Column, url: Column) -> Column:
    """Markdown of a push of its own. r: as checked_push gives it."""
    return _closed(F.concat(F.lit("# "), F.concat_ws("\n\n", title, r["hook"], r["body"], r["verdict"], r["closingQuestion"], _cite(source, url))))

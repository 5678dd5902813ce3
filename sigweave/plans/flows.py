"""Runs from end to end: fetched rows to a snapshot and the next state, a day's signals to prompts and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigweave.functions import dates, text, urls
from sigweave.operators import dedup, render, score, select
from sigweave.sources import pages


def enriched(rows: DataFrame, fetched: DataFrame, kind: str = "web-scraper") -> DataFrame:
    """rows (link, adapter, summary, ...) with the excerpt of the fetched article (url, html) where that is longer
    than the summary of a row of this adapter. Of several fetches of a url the longest excerpt serves."""
    texts = fetched.select(F.col("url").alias("_url"), pages.excerpt(F.col("html")).alias("_text")).where("_text is not null")
    texts = texts.groupBy("_url").agg(F.max_by("_text", F.struct(F.length("_text"), "_text")).alias("_text"))
    longer = (F.col("adapter") == kind) & (F.length("_text") > F.coalesce(F.length("summary"), F.lit(0)))
    out = rows.join(texts, F.col("link") == F.col("_url"), "left")
    return out.withColumn("summary", F.when(longer, F.col("_text")).otherwise(F.col("summary"))).drop("_url", "_text")


def collected(rows: DataFrame, state: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """The rows (source_slug, external_id, link, title, seq, ...) that no run has seen, with canonical links, and the state
    after them. Rows without id, link and title go; of a key's rows the first stays."""
    rows = rows.withColumn("link", F.coalesce(urls.canonical_url(F.col("link")), F.col("link")))
    keyed = rows.withColumn("dedup_key", urls.dedup_key(F.col("external_id"), F.col("link"), F.col("title")))
    fresh = dedup.new_rows(keyed, state, ["seq"])
    return fresh, dedup.next_state(state, fresh, as_of)


def marked(rows: DataFrame, n: int = 3) -> DataFrame:
    """Scored rows with is_leader (best of its category) and is_top (one of the n best leaders)."""
    lead = select.leaders(rows, "category", "score").select("seq", F.lit(True).alias("_lead"))
    top = select.top_leaders(rows, "category", "score", n).select("seq", F.lit(True).alias("_top"))
    out = rows.join(lead, "seq", "left").join(F.broadcast(top), "seq", "left")  # n rows
    return out.withColumn("is_leader", F.coalesce("_lead", F.lit(False))).withColumn("is_top", F.coalesce("_top", F.lit(False))).drop("_lead", "_top")


def day(signals: DataFrame, as_of: Column, context: DataFrame | None = None) -> DataFrame:
    """Signals of a day (as of sources.snapshots, with day) as scored rows with index, source_name, is_top and
    is_leader. Index counts the day's rows from 1."""
    rows = select.numbered(marked(score.scored(signals, as_of, context)), "day")
    return rows.withColumnRenamed("sourceName", "source_name")


def day_prompt(rows: DataFrame) -> DataFrame:
    """day, text: what the writer of a day's document is given. rows: as day() makes them, with day."""
    label = dates.date_label(F.col("ts"), F.col("rawMeta.dateInferred"))
    line = render.prompt_line(F.col("index"), F.col("category"), F.col("title"), F.col("source_name"), label, F.col("summary"), render.mark_of(F.col("is_top"), F.col("is_leader")))
    return render.joined(rows, "day", ["index"], line, "\n\n")


def pushes(rows: DataFrame, n: int = 2) -> DataFrame:
    """The rows fit for a push of their own, with its frame and file name."""
    out = select.candidates(rows, n).withColumn("frame", render.frame_of(F.col("title"), F.col("summary"), F.col("category")))
    return out.withColumn("filename", F.concat(F.col("day"), F.lit("-子推送-"), text.short_hash(text.first_filled(F.col("externalId"), F.col("title"))), F.lit(".md")))



def push_prompt(rows: DataFrame) -> DataFrame:
    """rows of pushes() with text: what the writer of a push is given. Instructions are the caller's; `frame` names the
    frame that they ask for."""
    parts = [F.lit("新闻标题："), F.col("title"), F.lit("\n类别："), F.col("category"), F.lit("\n来源："), F.col("source_name"), F.lit("\n摘要："), F.col("summary")]
    return rows.withColumn("text", F.concat(*[F.coalesce(p, F.lit("")) for p in parts]))


def week(signals: DataFrame, as_of: Column, n: int = 10) -> DataFrame:
    """A week's signals (as of sources.snapshots.week) as the n best representatives of its events, with index from 1."""
    best = select.representatives(score.scored(signals, as_of), "score", n)
    order = Window.orderBy(F.col("score").desc(), "cluster_id")  # n rows
    return best.withColumn("index", F.row_number().over(order)).withColumnRenamed("sourceName", "source_name")


def week_prompt(rows: DataFrame, monday: Column) -> DataFrame:
    """monday, text: what the writer of a week's document is given. rows: as week() makes them."""
    label = dates.date_label(F.col("ts"), F.col("rawMeta.dateInferred"))
    line = render.prompt_line(F.col("index"), F.col("category"), F.col("title"), F.col("source_name"), label, F.col("summary"))
    told = render.joined(rows.withColumn("monday", monday.cast("date")), "monday", ["index"], line, "\n\n")
    count = rows.agg(F.count("*").alias("n"))  # one row
    to = F.date_add("monday", 6).cast("string")
    head = F.concat(F.lit("上周（"), F.col("monday").cast("string"), F.lit(" 至 "), to, F.lit("）选出了 "), F.col("n").cast("string"), F.lit(" 条代表性热点，请据此生成周报：\n\n"))
    return told.join(F.broadcast(count)).select("monday", F.concat(head, "text").alias("text"))


def week_document(rows: DataFrame, response: Column, monday: Column) -> DataFrame:
    """monday, markdown of the writer's response (JSON text); none if it does not have the form asked for."""
    monday = monday.cast("date")
    said = rows.limit(1).select(monday.alias("monday"), render.checked_weekly(response).alias("r"))
    return render.weekly(said, rows.withColumn("monday", monday))

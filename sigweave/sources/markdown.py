"""Folders of written Markdown, their index, and the same as HTML."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.functions import dates, text
from sigweave.operators.render import HIGHLIGHTS

# Names of files (date, and the hash of a push), the title of untitled files, an old mark of pushes.
NAME = r"^(\d{4}-\d{2}-\d{2})(?:-子推送-([a-f0-9]+))?\.md$"
UNTITLED, OLD_MARK = "未命名", r"^子推送[:：]\s*"
PREVIEW = 3


def title(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(c, r"(?m)^#\s+(.+)$", 1)), F.lit("")), F.lit(UNTITLED))


def item_count(c: Column) -> Column:
    """Lines that are bold as a whole."""
    return F.regexp_count(c, F.lit(r"(?m)^\*\*(.+?)\*\*$"))


def highlights(c: Column) -> Column:
    section = F.regexp_extract(c, rf"##\s*{HIGHLIGHTS}\s*\n([\s\S]*?)(?=\n##|\n*\z)", 1)
    return F.transform(F.regexp_extract_all(section, F.lit(r"(?m)^-\s+(.+)$"), F.lit(1)), lambda x: F.trim(x))  # a bare trim would take the index for its characters


def date_range(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, r"(?m)^>\s*(.+)$", 1))


def briefing(c: Column) -> Column:
    """The first line that is neither empty nor a title nor quoted."""
    lines = F.filter(F.transform(F.split(c, "\n"), text.trim_ws), lambda x: (x != "") & ~x.startswith("#") & ~x.startswith(">"))
    return F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(""))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """filename, content of the Markdown files of a folder; none if there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "filename string, content string")
    rows = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return rows.select(F.col("_metadata.file_name").alias("filename"), F.col("value").alias("content"))


def entries(rows: DataFrame) -> DataFrame:
    """date, hash (null: the day's main file), filename, title, item_count, highlights of rows of filename, content."""
    main = F.regexp_extract("filename", NAME, 2) == ""
    return rows.where(F.col("filename").rlike(NAME)).select(
        F.regexp_extract("filename", NAME, 1).alias("date"), F.nullif(F.regexp_extract("filename", NAME, 2), F.lit("")).alias("hash"), "filename", title(F.col("content")).alias("title"),
        F.when(main, item_count(F.col("content"))).otherwise(F.lit(0)).alias("item_count"), F.when(main, F.slice(highlights(F.col("content")), 1, PREVIEW)).otherwise(F.array().cast("array<string>")).alias("highlights"),
    )


def days(listed: DataFrame) -> DataFrame:
    """A row a date with its main file and its pushes by filename, the newest first; dates without a main file go."""
    pushes = listed.where("hash is not null").groupBy("date").agg(F.sort_array(F.collect_list(F.struct("filename", F.regexp_replace("title", OLD_MARK, "").alias("title")))).alias("pushes"))
    return listed.where("hash is null").drop("hash").join(pushes, "date", "left").withColumn("header", dates.day_header(F.to_date("date"))).orderBy(F.col("date").desc())


def weeks(rows: DataFrame) -> DataFrame:
    c = F.col("content")
    found = rows.where(F.col("filename").rlike(r"^\d{4}-\d{2}-\d{2}\.md$"))
    out = found.select(F.substring("filename", 1, 10).alias("monday"), "filename", title(c).alias("title"), date_range(c).alias("date_range"), briefing(c).alias("briefing"), item_count(c).alias("item_count"))
    return out.orderBy(F.col("monday").desc())


def _inline(c: Column) -> Column:
    bold = F.regexp_replace(text.escape_html(c), r"\*\*(.+?)\*\*", "<strong>$1</strong>")
    return F.regexp_replace(bold, r'\[([^\]]*)\]\((https?://[^)\s"]+)\)', '<a href="$2">$1</a>')


def html(c: Column) -> Column:
    """Headings, quotes, lists, paragraphs, bold text and links; anything else is escaped text."""

    def block(b: Column) -> Column:
        tagged = lambda name, skip: F.concat(F.lit(f"<{name}>"), _inline(F.regexp_replace(b, skip, "")), F.lit(f"</{name}>"))
        listed = F.array_join(F.transform(F.split(b, "\n"), lambda x: F.concat(F.lit("<li>"), _inline(F.regexp_replace(x, r"^-\s+", "")), F.lit("</li>"))), "")
        cases = F.when(b.rlike(r"^#\s"), tagged("h1", r"^#\s+")).when(b.rlike(r"^##\s"), tagged("h2", r"^##\s+")).when(b.rlike(r"^###\s"), tagged("h3", r"^###\s+"))
        cases = cases.when(b.startswith(">"), F.concat(F.lit("<blockquote>"), tagged("p", r"(?m)^>\s?"), F.lit("</blockquote>")))
        return cases.when(b.rlike(r"^-\s"), F.concat(F.lit("<ul>"), listed, F.lit("</ul>"))).otherwise(tagged("p", "^$"))

    blocks = F.filter(F.transform(F.split(c, r"\n\s*\n"), text.trim_ws), lambda b: b != "")
    return F.array_join(F.transform(blocks, block), "\n")


def page(heading: Column, body: Column, back: str) -> Column:
    """A whole page. body: HTML."""
    top = F.concat(F.lit('<!doctype html>\n<html lang="zh">\n<head><meta charset="utf-8"><title>'), text.escape_html(heading), F.lit("</title></head>\n<body>\n"))
    return F.concat(top, F.lit(f'<nav><a href="{back}">←</a></nav>\n<main>'), body, F.lit("</main>\n</body>\n</html>\n"))


def _linked(filename: Column, label: Column, folder: str) -> Column:
    return F.concat(F.lit(f'<a href="{folder}'), F.regexp_replace(filename, r"\.md$", ".html"), F.lit('">'), text.escape_html(label), F.lit("</a>"))


def day_item(folder: str = "digests/") -> Column:
    """The entry of a row of days() in the index."""
    pushes = F.transform(F.coalesce("pushes", F.array().cast("array<struct<filename: string, title: string>>")), lambda p: F.concat(F.lit("<li>"), _linked(p["filename"], p["title"], folder), F.lit("</li>")))
    preview = F.transform("highlights", lambda h: F.concat(F.lit("<li>"), text.escape_html(h), F.lit("</li>")))
    return F.concat(F.lit("<li><p>"), "header", F.lit("</p>"), _linked(F.col("filename"), F.col("title"), folder), F.lit("<ul>"), F.array_join(F.concat(preview, pushes), ""), F.lit("</ul></li>"))


def site(main: DataFrame, weekly: DataFrame) -> DataFrame:
    """name, content of every page of the site: main and weekly are rows of filename, content."""
    pages = lambda rows, folder: rows.select(F.concat(F.lit(folder), F.regexp_replace("filename", r"\.md$", ".html")).alias("name"), page(title(F.col("content")), html(F.col("content")), "../index.html" if folder == "digests/" else "index.html").alias("content"))
    listed = lambda rows, order: F.array_join(F.transform(F.reverse(F.sort_array(F.collect_list(F.struct(order, rows.alias("entry"))))), lambda x: x["entry"]), "\n")
    whole = lambda heading, name, c, back: (F.lit(name).alias("name"), page(F.lit(heading), F.concat(F.lit("<ul>"), c, F.lit("</ul>")), back).alias("content"))
    # an index has a line a day or a week
    index = days(entries(main)).agg(listed(day_item(), "date").alias("c")).select(*whole("Digests", "index.html", F.col("c"), "weekly/index.html"))
    week = F.concat(F.lit("<li>"), _linked(F.col("filename"), F.col("title"), ""), F.lit("<p>"), text.escape_html(F.col("date_range")), F.lit("</p><p>"), text.escape_html(F.col("briefing")), F.lit("</p></li>"))
    week_index = weeks(weekly).agg(listed(week, "monday").alias("c")).select(*whole("Weeks", "weekly/index.html", F.col("c"), "../index.html"))
    named = main.where(F.col("filename").rlike(NAME))
    return pages(named, "digests/").unionByName(pages(weekly.where(F.col("filename").rlike(r"^\d{4}-\d{2}-\d{2}\.md$")), "weekly/")).unionByName(index).unionByName(week_index)


def write(rows: DataFrame, folder: str) -> int:
    """Writes rows of name, content as files of a folder, over old ones; the number written. Executors write the texts into
    a folder on the side, one job that fails as a whole; the driver then only moves files to their names. Of rows with
    one name the greatest content stays; a file ends with a line end; rows without name go."""
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = hadoop.Path(f"{folder}/_aside-{uuid.uuid4().hex}")
    once = rows.where("name is not null and name <> ''").groupBy("name").agg(F.max(F.coalesce("content", F.lit(""))).alias("content"))
    try:
        once.select("name", F.regexp_replace("content", r"\n\z", "").alias("value")).repartition("name").write.partitionBy("name").text(aside.toString())
        made = files.globStatus(hadoop.Path(f"{aside.toString()}/name=*/part-*"))
        for status in made:
            to = hadoop.Path(f"{folder}/{unquote(status.getPath().getParent().getName().removeprefix('name='))}")
            files.mkdirs(to.getParent())
            files.delete(to, False)
            if not files.rename(status.getPath(), to):
                raise OSError(f"{to} could not be written")
        return len(made)
    finally:
        files.delete(aside, True)

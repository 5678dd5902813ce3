"""Chat formatting by quotation linking, with DataFrame functions only.

A line that begins with `>` marks is quoted, as deep as it has marks (`> >`, `>>`). A passage is a run of lines
of one depth. Passages are normalised (lower case, single spaces) and hashed. Every message also files what it
says itself (depth 0) under the hashes of its whole body, its paragraphs and its lines, the earliest turn of a
conversation first. A quoted passage of depth 1 is joined to its original by the hash of the whole passage,
else by those of its lines; a message's parent is the latest of these originals. Deeper passages are linked in
the same way and counted, but belong to earlier replies. Then each message gets its thread (by pointer doubling
over the messages that have a parent) and its position: threads by their first turn, turns in order, so that a
reply follows what it answers. `content` is the message without quoted lines and attribution lines before them.

Positions come from a range partitioning and counts by partition; no conversation has to fit in one task.
Defined results: null text is an empty message; rows with null conv_id or turn stay, last in order, and are
never linked; repeated rows are a message each; a message that quotes nothing known has no parent; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, text_of, written

MARKS = r"^[ \t]*(?:>[ \t]?)+"
ATTRIBUTION = r"(?:wrote|schrieb|écrit|escribió)[ \t]?:[ \t]*$"
#: Characters of a normalised passage below which it links nothing by itself, unless a caller asks for others: "Yes." and
#: "Thanks!" are said by many turns. 1 links every passage.
LEAST = 12


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def lines(text: Column) -> Column:
    """A message's lines as structs: depth, body (without marks)."""

    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(F.length(F.regexp_replace(marks, "[^>]", "")).alias("depth"), F.when(marks == "", line).otherwise(F.regexp_replace(line, MARKS, "")).alias("body"))

    return F.transform(F.split(text, r"\r\n|\r|\n"), one)


def passages(parsed: Column) -> Column:
    """Runs of lines of one depth, as structs: depth, bodies. Linear: where the depth changes a run starts, and each run is
    a slice from its start to the next."""
    starts = F.filter(F.transform(parsed, lambda line, i: F.struct(i.alias("i"), ((i == 0) | (F.get(parsed, i - 1)["depth"] != line["depth"])).alias("first"))), lambda x: x["first"])
    bounded = F.transform(F.array(starts), lambda s: F.transform(s, lambda x, k: F.struct(x["i"].alias("at"), F.coalesce(F.get(s, k + 1)["i"], F.size(parsed)).alias("to"))))[0]
    return F.transform(bounded, lambda x: F.struct(F.get(parsed, x["at"])["depth"].alias("depth"), F.transform(F.slice(parsed, x["at"] + 1, x["to"] - x["at"]), lambda line: line["body"]).alias("bodies")))


def parsed(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """mid, conv_id, turn, role, content, quoted (passages of depth 1 and more), of every message."""
    rows = pick(conversations, conv_id=conv, turn=turn, role=role, text=text)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), text_of("text").alias("text"))
    plain = ~F.col("text").rlike(r"(?m)^[ \t]*>")
    rows = rows.withColumn("lines", F.when(plain, F.lit(None)).otherwise(lines(F.col("text"))))
    attribution = F.transform("lines", lambda x, i: (x["depth"] == 0) & x["body"].rlike(ATTRIBUTION) & (F.coalesce(F.try_element_at("lines", i + 2)["depth"], F.lit(0)) > 0))
    own = F.filter(F.arrays_zip("lines", attribution.alias("by")), lambda x: (x["lines"]["depth"] == 0) & ~x["by"])
    said = F.array_join(F.transform(own, lambda x: x["lines"]["body"]), "\n")
    content = F.when(plain, F.col("text")).otherwise(F.regexp_replace(F.regexp_replace(said, r"\n{3,}", "\n\n"), r"^\n+|\n+$", ""))
    quoted = F.when(plain, F.array().cast("array<struct<depth:int,bodies:array<string>>>")).otherwise(F.filter(passages(F.col("lines")), lambda p: p["depth"] > 0))
    return rows.select("conv_id", "turn", "role", content.alias("content"), quoted.alias("quoted"))


def _hash(c: Column) -> Column:
    return F.sha2(_normal(c), 256)


def link(messages: DataFrame, least: int = LEAST) -> DataFrame:
    """conv_id, turn, depth, n (passage of the message), original: the earliest turn that says the passage. Passages of
    under `least` characters link nothing."""
    asked = messages.where("size(quoted) > 0 and conv_id is not null and turn is not null")
    asked = asked.select("conv_id", "turn", F.posexplode("quoted").alias("n", "passage"))
    asked = asked.select("conv_id", "turn", "n", F.col("passage.depth").alias("depth"), F.filter("passage.bodies", lambda b: F.trim(b) != "").alias("bodies"))
    whole = asked.select("conv_id", "turn", "n", "depth", F.lit(0).alias("rank"), _hash(F.array_join("bodies", " ")).alias("h"), F.array_join("bodies", " ").alias("t"))
    each = asked.select("conv_id", "turn", "n", "depth", F.lit(1).alias("rank"), F.explode("bodies").alias("t")).withColumn("h", _hash(F.col("t")))
    asked = written(whole.unionByName(each).where(F.length(_normal(F.col("t"))) >= least).drop("t"), "quoted")
    talking = asked.select("conv_id").distinct()
    said = messages.where("conv_id is not null and turn is not null").join(talking, "conv_id", "left_semi")
    parts = F.concat(F.array("content"), F.split("content", r"\n[ \t]*\n"), F.split("content", r"\n"))
    said = said.select("conv_id", "turn", F.explode(F.array_distinct(parts)).alias("t")).where(F.length(_normal(F.col("t"))) >= least)
    first = written(said.select("conv_id", "turn", _hash(F.col("t")).alias("h")).groupBy("conv_id", "h").agg(F.min("turn").alias("original")), "said")
    found = asked.join(first, ["conv_id", "h"]).where("original < turn")
    return found.groupBy("conv_id", "turn", "n", "depth").agg(F.max_by("original", F.struct(-F.col("rank"), F.col("original"))).alias("original"))


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, parent, root, depth of the turns that answer one. Pointer doubling: rounds grow with the
    logarithm of the longest chain."""
    parents = links.where("depth = 1").groupBy("conv_id", "turn").agg(F.max("original").alias("parent"))
    now = written(parents.select("conv_id", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        joined = now.join(up, ["conv_id", "root"], "left")
        if joined.where("higher is not null").isEmpty():
            return now
        now = written(joined.select("conv_id", "turn", "parent", F.coalesce("higher", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")


def chats(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", least: int = LEAST) -> DataFrame:
    """conv_id, position, turn, role, content, parent_turn, thread_turn, reply_depth, n_quoted, n_linked."""
    messages = written(parsed(conversations, conv, turn, role, text), "messages")
    links = written(link(messages, least), "links")
    linked = links.groupBy("conv_id", "turn").agg(F.count("*").alias("n_linked"))
    placed = written(threads(links).join(linked, ["conv_id", "turn"]), "linked")
    rows = messages.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "content", F.col("parent").alias("parent_turn"), F.coalesce("root", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("reply_depth"), F.size("quoted").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "thread_turn", "turn", "role")] + [F.xxhash64("content")]
    dealt = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "chats")
    here = Window.partitionBy("conv_id", "part").orderBy(*order)
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "before")
    ranked = dealt.withColumn("place", F.row_number().over(here))
    joined = ranked.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    names = ["turn", "role", "content", "parent_turn", "thread_turn", "reply_depth", "n_quoted", "n_linked"]
    return joined.select("conv_id", (F.col("before") + F.col("place") - 1).cast("long").alias("position"), *names)

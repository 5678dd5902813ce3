"""Dates. The clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Singapore"


def business_day(ts: Column, zone: str = ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def monday_of(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def last_week(day: Column) -> Column:
    """Monday to Sunday of the week before."""
    monday = F.date_sub(monday_of(day), 7)
    return F.sequence(monday, F.date_add(monday, 6))


def parse_date(c: Column) -> Column:
    """Formats of feeds and pages, UTC where none is named; else null."""
    plain = F.trim(F.regexp_replace(c, r"^(?:[A-Za-z]{3,9},\s*)", ""))
    chinese = F.regexp_extract(c, r"((?:19|20)\d{2})年(\d{1,2})月(\d{1,2})日", 0)
    formats = ["yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSS]", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy"]
    tries = [F.try_to_timestamp(plain, F.lit(f)) for f in formats]
    return F.coalesce(F.try_to_timestamp(F.nullif(chinese, F.lit("")), F.lit("yyyy年M月d日")), *tries)


def dated(c: Column, as_of: Column) -> Column:
    """Struct of published and inferred: as_of where the text is no date."""
    found = parse_date(c)
    return F.struct(F.coalesce(found, as_of).alias("published"), found.isNull().alias("inferred"))


def date_label(ts: Column, inferred: Column) -> Column:
    return F.when(ts.isNull() | inferred.eqNullSafe(F.lit(True)), F.lit("未知")).otherwise(F.date_format(ts, "yyyy-MM-dd"))


def month_day(day: Column) -> Column:
    return F.concat(F.month(day).cast("string"), F.lit("月"), F.dayofmonth(day).cast("string"), F.lit("日"))


def day_header(day: Column) -> Column:
    names = F.array(*[F.lit(x) for x in "日一二三四五六"])
    return F.concat(month_day(day), F.lit(" · 周"), F.element_at(names, F.dayofweek(day)))


def month_start(c: Column, as_of: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(F.concat(c, F.lit("-01")), F.lit("yyyy-MM-dd")), as_of)

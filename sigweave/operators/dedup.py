"""Keyed dedup: within a batch, and against a state of keys with the time they were first seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETENTION_DAYS = 30


def first_wins(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def drop_repeated_titles(rows: DataFrame, page: str, title: str) -> DataFrame:
    """Rows whose title, in any case, no other row of the page has."""
    return rows.withColumn("_n", F.count("*").over(Window.partitionBy(page, F.lower(title)))).where("_n < 2").drop("_n")


def new_rows(rows: DataFrame, state: DataFrame, order: list[str]) -> DataFrame:
    """Rows (source_slug, dedup_key) that the state doesn't know, first of each key; keyless rows are left out.
    The state isn't pruned here: a key past its time still blocks in the run that prunes it."""
    fresh = first_wins(rows.where("dedup_key is not null"), ["source_slug", "dedup_key"], order)
    return fresh.join(state.select("source_slug", "dedup_key"), ["source_slug", "dedup_key"], "left_anti")


def pruned(state: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return state.where(F.col("first_seen") >= as_of - F.expr(f"interval {days} days"))


def next_state(state: DataFrame, fresh: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """The state with the new keys, without those first seen more than `days` ago."""
    both = state.select("source_slug", "dedup_key", "first_seen").union(fresh.select("source_slug", "dedup_key", as_of.alias("first_seen")))
    return pruned(both, as_of, days)


def run_report(rows: DataFrame, fresh: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """source_slug, fetched, new, error."""
    out = rows.groupBy("source_slug").agg(F.count("*").alias("fetched")).join(fresh.groupBy("source_slug").agg(F.count("*").alias("new")), "source_slug", "left")
    out = out.select("source_slug", "fetched", F.coalesce("new", F.lit(0)).alias("new"))
    if errors is None:
        return out.withColumn("error", F.lit(None).cast("string"))
    out = out.join(errors.select("source_slug", "error"), "source_slug", "full")
    return out.select("source_slug", F.coalesce("fetched", F.lit(0)).alias("fetched"), F.coalesce("new", F.lit(0)).alias("new"), "error")

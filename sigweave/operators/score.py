"""Scores of a day's or a week's signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave import schema
from sigweave.functions import scoring, text

from .cluster import clustered


def features(signals: DataFrame, compose: bool = True) -> DataFrame:
    """Signals (as of sources.snapshots) with ts, fp and tokens, computed once a row."""
    title = text.nfkc(F.col("title")) if compose else F.col("title")
    rows = signals.withColumn("ts", F.try_to_timestamp("publishedAt")).withColumn("_title", title)  # composed once for both
    return rows.withColumn("fp", text.fingerprint(F.col("_title"), False)).withColumn("tokens", text.title_tokens(F.col("_title"), False)).drop("_title")


def with_source(rows: DataFrame) -> DataFrame:
    """rows (source_slug, ...) with authority and is_primary of their source; null and false where it isn't known."""
    sources = rows.sparkSession.createDataFrame(schema.SOURCES, schema.SOURCE).select("source_slug", "authority", "is_primary")
    return rows.join(F.broadcast(sources), "source_slug", "left").withColumn("is_primary", F.coalesce("is_primary", F.lit(False)))  # 16 rows


def scored(signals: DataFrame, as_of: Column, context: DataFrame | None = None) -> DataFrame:
    """Signals with confidence, heat, score, cluster_id and cluster_size. context: rows of earlier days, after all
    signals in seq; they shape clusters and are not returned."""
    pool = signals.withColumn("scored", F.lit(True))
    if context is not None:
        pool = pool.unionByName(context.withColumn("scored", F.lit(False)))
    pool = clustered(features(pool).withColumnRenamed("sourceSlug", "source_slug")).where("scored").drop("scored")
    rows = with_source(pool)
    known = ~F.coalesce(F.col("rawMeta.dateInferred"), F.lit(False))
    hours = (F.unix_micros(as_of) - F.unix_micros("ts")) / 3.6e9
    both = F.concat_ws(" ", "title", "summary")
    rows = rows.withColumn("confidence", scoring.confidence(F.col("authority"), F.col("is_primary"), F.col("cluster_size")))
    rows = rows.withColumn("heat", scoring.heat(F.col("category"), F.col("cluster_size"), both, hours, known))
    return rows.withColumn("score", F.col("confidence") + F.col("heat"))

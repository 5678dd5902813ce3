"""Leaders, top lists and representatives. Every order ends in seq, so ties are stable."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored


def best_per(rows: DataFrame, group: str, score: str, seq: str = "seq") -> DataFrame:
    """The row with the highest score of each group; the earliest of equals."""
    return top_per(rows, group, score, 1, seq)


def top_per(rows: DataFrame, group: str, score: str, n: int, seq: str = "seq") -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(seq))
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def leaders(rows: DataFrame, group: str, score: str, seq: str = "seq") -> DataFrame:
    """The best row of each group, with first_seq: where the group first appears."""
    first = rows.groupBy(group).agg(F.min(seq).alias("first_seq"))
    return best_per(rows, group, score, seq).join(first, group)


def top_leaders(rows: DataFrame, group: str, score: str, n: int = 3, seq: str = "seq") -> DataFrame:
    """The n best leaders; equal ones in the order in which their groups appear."""
    return leaders(rows, group, score, seq).orderBy(F.col(score).desc(), "first_seq").limit(n)


def representatives(rows: DataFrame, score: str, n: int = 10, seq: str = "seq") -> DataFrame:
    """The best row of each cluster; of these the n best, equal ones in the order of cluster creation."""
    return best_per(rows, "cluster_id", score, seq).orderBy(F.col(score).desc(), "cluster_id").limit(n)


def candidates(rows: DataFrame, n: int = 2, confidence: int = 60, heat: int = 60, length: int = 60) -> DataFrame:
    """Rows fit for a push of their own, the n best."""
    fit = rows.where((F.col("confidence") >= confidence) & (F.col("heat") >= heat) & (F.length("summary") >= length))
    return fit.orderBy((F.col("confidence") + F.col("heat")).desc(), "seq").limit(n)


def take(rows: DataFrame, group: str, n: int, order: str) -> DataFrame:
    """The first n rows of each group."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_rank") <= n).drop("_rank")


def split_top(items: DataFrame, top: DataFrame, key: str = "index") -> tuple[DataFrame, DataFrame]:
    """Items in the top list, and the rest."""
    return items.join(top.select(key), key, "left_semi"), items.join(top.select(key), key, "left_anti")


def by_index(items: DataFrame, rows: DataFrame, key: str = "index") -> DataFrame:
    """Written items with the collected row of their index; the last item of an index wins; rows without one go."""
    last = items.groupBy(key).agg(F.max_by(F.struct(*[c for c in items.columns if c != key]), "pos").alias("item"))
    return rows.join(last, key).select(*rows.columns, "item.*")


def numbered(rows: DataFrame, group: str, order: str = "seq", name: str = "index") -> DataFrame:
    """rows with their place in the group's order, from 1. Rows are dealt by ranges of (group, order), numbered in their
    range, and moved on by the counts of the ranges before: no group has to be in one task. order: distinct in a group."""
    dealt = stored(rows.repartitionByRange(group, order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))  # a row for each range and group
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(group, "_part").orderBy(order))
    placed = dealt.withColumn("_here", here).join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_p")))
    return placed.withColumn(name, (F.col("_before") + F.col("_here")).cast("int")).drop("_part", "_group", "_p", "_before", "_here")

"""Dated snapshot files, and tables partitioned by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave import schema


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read(spark: SparkSession, folder: str, days: list[str]) -> DataFrame:
    """Signals of the days that have a file, in the order given: all fields, day, seq (day by day, by place in the file)."""
    paths = [f"{folder}/{d}.json" for d in days if _exists(spark, f"{folder}/{d}.json")]
    if not paths:
        return spark.createDataFrame([], f"{schema.SIGNAL}, day string, collectedAt string, seq long")
    files = spark.read.schema(schema.SNAPSHOT).json(paths, multiLine=True)
    day = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1)
    order = F.array_position(F.array(*[F.lit(d) for d in days]), day)
    rows = files.select(day.alias("day"), order.alias("nth"), "collectedAt", F.posexplode(F.coalesce("signals", F.array())).alias("pos", "s"))
    seq = (F.col("nth") * F.lit(1 << 32) + F.col("pos")).cast("long")
    return rows.select("s.*", "day", "collectedAt", seq.alias("seq"))


def week(rows: DataFrame, monday: Column) -> DataFrame:
    """Rows of the seven days from monday; prunes partitions of day."""
    return rows.where((F.col("day") >= monday) & (F.col("day") <= F.date_add(monday, 6)))


def lookback(rows: DataFrame, day: Column, days: int = 3) -> DataFrame:
    """Rows of the days before day."""
    return rows.where((F.col("day") >= F.date_sub(day, days)) & (F.col("day") <= F.date_sub(day, 1)))


def append(rows: DataFrame, path: str) -> None:
    """Adds a run's new rows to a table partitioned by day; a second run of a day adds, it doesn't replace."""
    rows.write.mode("append").partitionBy("day").parquet(path)

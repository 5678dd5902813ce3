"""What runs have seen: JSON text, {source: {key: time first seen}}, a table in versions, and a table by day, of which a
run writes only its own keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.operators import dedup

STATE = "source_slug string, dedup_key string, first_seen timestamp"


def parsed(texts: DataFrame) -> DataFrame:
    """The state of texts (body). A text that isn't such an object fails the job: taken for an empty state, it would make
    every known key new. A time that can't be read is null; such a key is known until the state is next written."""
    whole = texts.select(F.from_json("body", "map<string, map<string, string>>", {"mode": "FAILFAST"}).alias("m"))
    keys = whole.select(F.explode("m").alias("source_slug", "keys")).select("source_slug", F.explode("keys").alias("dedup_key", "at"))
    return keys.select("source_slug", "dedup_key", F.try_to_timestamp("at").alias("first_seen"))


def as_json(state: DataFrame) -> DataFrame:
    """source_slug, body: a JSON object a source, of keys in order and their times in UTC. A source's keys are one row."""
    at = F.date_format(F.to_utc_timestamp("first_seen", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    keys = F.sort_array(F.collect_list(F.struct("dedup_key", at.alias("at"))))
    return state.groupBy("source_slug").agg(keys.alias("keys")).select("source_slug", F.to_json(F.create_map("source_slug", F.map_from_entries("keys"))).alias("body"))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """The state of a file as runs keep it; empty where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], STATE)
    return parsed(spark.read.text(path, wholetext=True).select(F.col("value").alias("body")))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were written to their end."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    done = files.globStatus(hadoop.Path(f"{path}/v*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName()[1:]) for s in done or [])


def load(spark: SparkSession, path: str) -> DataFrame:
    """The last version that was written to its end; empty where there is none."""
    versions = _versions(spark, path)
    return spark.read.schema(STATE).parquet(f"{path}/v{versions[-1]}") if versions else spark.createDataFrame([], STATE)


def save(state: DataFrame, path: str, as_of, days: int = dedup.RETENTION_DAYS) -> None:
    """Writes the state as the next version, without keys first seen more than `days` before as_of. A run that ends on
    the way leaves the version before in force; state may be what load() gave."""
    versions = _versions(state.sparkSession, path)
    kept = dedup.pruned(state.select("source_slug", "dedup_key", "first_seen"), as_of, days)
    kept.write.mode("overwrite").parquet(f"{path}/v{versions[-1] + 1 if versions else 0}")


def _parts(spark: SparkSession, path: str, name: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(f"{path}/{name}"))
    return sorted(s.getPath().toString() for s in found or [])


def _cutoff(spark: SparkSession, path: str) -> int | None:
    """Microseconds before which keys are forgotten, by the last drop_days()."""
    return max((int(p.rsplit("=", 1)[1]) for p in _parts(spark, path, "cutoff=*")), default=None)


def _clock(spark: SparkSession, as_of: Column | str, days: int = 0) -> tuple[int, str]:
    """as_of, less days: microseconds and the day in UTC."""
    at = spark.range(1).select(((as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp") - F.expr(f"interval {days} days")).alias("at"))
    r = at.select(F.unix_micros("at").alias("us"), F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM-dd").alias("day")).first()
    return r["us"], r["day"]


def load_days(spark: SparkSession, path: str) -> DataFrame:
    """The keys of all runs that ended, without forgotten ones; empty where there is none."""
    ended = [p.rsplit("/", 1)[0] for p in _parts(spark, path, "day=*/run=*/_SUCCESS")]
    rows = spark.read.schema(STATE).parquet(*ended) if ended else spark.createDataFrame([], STATE)
    cut = _cutoff(spark, path)
    return rows if cut is None else rows.where(F.unix_micros("first_seen") >= cut)


def add_day(fresh: DataFrame, path: str, as_of: Column | str) -> None:
    """Adds a run's new keys (source_slug, dedup_key) to its day: what is written grows with them alone. A run that fails
    on the way leaves a part without its mark of success, which load_days() passes over."""
    us, day = _clock(fresh.sparkSession, as_of)
    keys = fresh.select("source_slug", "dedup_key", F.timestamp_micros(F.lit(us)).alias("first_seen"))
    keys.write.parquet(f"{path}/day={day}/run={us}-{uuid.uuid4().hex}")


def drop_days(spark: SparkSession, path: str, as_of: Column | str, days: int = dedup.RETENTION_DAYS) -> None:
    """Forgets keys first seen more than `days` before as_of: whole days go with their files, the rest of a day by the
    cutoff that is kept. Nothing is rewritten."""
    us, day = _clock(spark, as_of, days)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    before = _cutoff(spark, path)
    if before is None or before < us:
        files.mkdirs(hadoop.Path(f"{path}/cutoff={us}"))
    for old in _parts(spark, path, "day=*"):
        if old.rsplit("=", 1)[1] < day:
            files.delete(hadoop.Path(old), True)
    for old in _parts(spark, path, "cutoff=*"):
        if int(old.rsplit("=", 1)[1]) < us and (before is None or before < us):
            files.delete(hadoop.Path(old), True)

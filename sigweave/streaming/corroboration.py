"""How many sources tell of one event in a stream: by fingerprint and category over the days that a run looks back, or by
the batch scores of the days that new rows reach."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigweave.operators import score
from sigweave.operators.tables import stored

#: A day and the three before it.
SPAN, STEP, LATE = "4 days", "1 day", "1 day"


def corroborated(stream: DataFrame, ts: str = "ts", span: str = SPAN, step: str = STEP, late: str = LATE) -> DataFrame:
    """from_ts, to_ts, category, fp, sources of rows (ts, category, fp, source_slug). Built-in operators only: state is a
    set of sources an event and window, dropped when the watermark passes the window."""
    seen = stream.where("fp is not null").withWatermark(ts, late)
    counted = seen.groupBy(F.window(ts, span, step), "category", "fp").agg(F.size(F.collect_set("source_slug")).alias("sources"))
    return counted.select(F.col("window.start").alias("from_ts"), F.col("window.end").alias("to_ts"), "category", "fp", "sources")


#: Added to the seq of earlier days' rows, which come after a day's own.
EARLIER = 1 << 50


def end_of(day: str) -> Column:
    """The clock by which a day is scored."""
    return F.date_add(F.lit(day).cast("date"), 1).cast("timestamp")


def scored_day(signals: DataFrame, day: str, as_of: Callable[[str], Column] = end_of, back: int = 3) -> DataFrame:
    """The rows of a day scored among those of the `back` days before. signals: with day (text) and seq."""
    first = F.date_sub(F.lit(day).cast("date"), back).cast("string")
    own, earlier = signals.where(F.col("day") == day), signals.where((F.col("day") >= first) & (F.col("day") < day))
    return score.scored(own, as_of(day), earlier.withColumn("seq", F.col("seq") + EARLIER))


def score_stream(stream: DataFrame, folder: str, as_of: Callable[[str], Column] = end_of, back: int = 3) -> StreamingQuery:
    """Keeps folder/scored, a part a day, as scored_day() would give it over all rows so far. A batch's rows go to
    folder/signals/epoch=<id>, over what an earlier try of that batch left; then each day that they can reach, up to `back`
    days on, is scored anew and put over its old part. So a batch that is replayed changes nothing. stream: as signals
    of scored_day(); needs columns that Parquet can hold."""

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{folder}/signals/epoch={epoch}")
        here = spark.read.schema(batch.schema).parquet(f"{folder}/signals/epoch={epoch}")
        touched = here.select(F.explode(F.sequence(F.to_date("day"), F.date_add(F.to_date("day"), back))).alias("at")).select(F.col("at").cast("string").alias("day")).distinct()
        every = spark.read.schema(batch.schema).option("recursiveFileLookup", True).parquet(f"{folder}/signals")
        days = [r["day"] for r in every.select("day").distinct().join(touched, "day", "left_semi").orderBy("day").collect()]  # some days a batch
        for day in days:
            rows = stored(scored_day(every, day, as_of, back), "scored")
            rows.write.mode("overwrite").parquet(f"{folder}/scored/day={day}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

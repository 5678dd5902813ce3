"""First-seen dedup of a stream: a key is emitted once and forgotten `days` after it was first seen, by
processing time; seeing it again doesn't prolong that."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class _FirstSeen(StatefulProcessor):
    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", ttlDurationMs=self.days * 86_400_000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = next((pdf.head(1) for pdf in rows if len(pdf)), None)
        if first is not None and not self.seen.exists():
            self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))
            yield first

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, keys: list[str], days: int = 30) -> DataFrame:
    """Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass)."""
    return stream.groupBy(*keys).transformWithStateInPandas(_FirstSeen(days), outputStructType=stream.schema, outputMode="Append", timeMode="ProcessingTime")


def first_in_window(stream: DataFrame, keys: list[str], ts: str, delay: str = "30 days") -> DataFrame:
    """By event time instead: built-in operators only, another clock."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)

"""Adapters by kind: functions from fetched bodies and the clock to signals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from . import feeds, pages

ADAPTERS: dict[str, Callable[[DataFrame, Column], DataFrame]] = {"web-scraper": pages.signals, "rss": feeds.signals, "lta-coe": feeds.bid_signals}


def adapter(kind: str) -> Callable[[DataFrame, Column], DataFrame]:
    if kind not in ADAPTERS:
        raise ValueError(f"unknown adapter: {kind}")
    return ADAPTERS[kind]

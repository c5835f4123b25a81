"""The stateless stages on streams: links as they arrive, counts by window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import text as X


def link_stream(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, markup) of a stream of texts (keys, text) without nested links."""
    return texts.select(*keys, F.explode(X.flat_links(F.col("text"))).alias("markup"))


def windowed_counts(events: DataFrame, key: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by key and event-time window; in append mode later events than ``late`` are dropped, as any watermark does."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", window), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n")

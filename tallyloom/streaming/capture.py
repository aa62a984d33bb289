"""Incremental capture with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def first_seen(stream: DataFrame, key: str, event_time: str, late: str = "1 hour") -> DataFrame:
    """The first row of every key within the watermark; state older than it is dropped."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])


def unseen(stream: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Stream-static anti join: rows whose key is not known yet."""
    return stream.join(known.select(key).distinct(), key, "left_anti")


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there and stop; restarts resume from the checkpoint."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
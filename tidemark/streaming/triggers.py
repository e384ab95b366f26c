"""When a stream runs: on a fixed beat, or once over what has arrived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: seconds between two market refreshes.
REFRESH_SECONDS = 60


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Start at once (T2). With ``every_seconds`` keep a beat (T1), else stop when done."""
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()

"""Active section per session over arriving scroll events.

Each batch runs the batch operator, whose hot sessions are cut into chunks, and starts
from the section each session ended in before. A keyed state function would instead hand a
whole session's share of the batch to one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.operators.attribution import (
    carry_section,
    disjoint_pieces,
    section_from_pieces,
    with_section,
)
from tidemark.sources.sinks import BATCH, read_batches, read_if_written, write_batch
from tidemark.streaming.triggers import start

ACTIVE = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("session_id", LongType(), True),
        StructField("active_section", StringType(), True),
    ]
)
ENDED = StructType(
    [
        StructField("session_id", LongType(), True),
        StructField("ended_in", StringType(), True),
    ]
)

PIECES = StructType(
    [
        StructField("at", DoubleType(), True),
        StructField("section_id", StringType(), True),
    ]
)

# Every so many batches the state of all sessions is written again, so that a batch
# never has to read more than this many state folders.
FULL_STATE_EVERY = 20


@dataclass(frozen=True)
class SectionTracking:
    spark: SparkSession
    root: str
    sections: DataFrame | list
    full_state_every: int = FULL_STATE_EVERY

    def start(self, events: DataFrame, every_seconds: int | None = None) -> StreamingQuery:
        """``events``: a stream of session_id, ts, event_id, scroll_y."""
        return start(events, self.on_batch, f"{self.root}/_stream", every_seconds)

    def on_batch(self, events: DataFrame, batch_id: int) -> None:
        state = self.ended(before=batch_id)
        # Read for the sessions touched, their last sections and the active rows.
        seen = self._placed(events).persist()
        placed = F.when(F.col("section_id").isNotNull(), F.struct("ts", "event_id"))
        touched = seen.groupBy("session_id").agg(F.max_by("section_id", placed).alias("ended_in"))
        try:
            # What a session ended in before is its first row now: null times sort first.
            # So the state needs no join to the events.
            seeds = state.join(touched, "session_id", "left_semi").select(
                "session_id", F.col("ended_in").alias("section_id"), F.lit(True).alias("__seed")
            )
            rows = seen.withColumn("__seed", F.lit(False))
            rows = rows.unionByName(seeds, allowMissingColumns=True)
            active = carry_section(rows).filter("NOT __seed")
            write_batch(active.select(*ACTIVE.names), f"{self.root}/active", batch_id)

            moved = touched.filter(F.col("ended_in").isNotNull())
            if batch_id % self.full_state_every == 0:
                unmoved = state.join(moved, "session_id", "left_anti")
                moved = moved.unionByName(unmoved)
            write_batch(moved, f"{self.root}/ended", batch_id)
        finally:
            seen.unpersist()

    def _placed(self, events: DataFrame) -> DataFrame:
        """Events with their section; a table of sections is swept once, for all batches."""
        if not isinstance(self.sections, DataFrame):
            return with_section(events, self.sections)
        path = f"{self.root}/pieces"
        pieces = read_if_written(self.spark, path, PIECES)
        if pieces is None:
            disjoint_pieces(self.sections).write.parquet(path)
            pieces = self.spark.read.schema(PIECES).parquet(path)
        return section_from_pieces(events, pieces)

    def ended(self, before: int | None = None) -> DataFrame:
        """Section each session ended in: newest row since the last full state."""
        rows = read_batches(self.spark, f"{self.root}/ended", ENDED, before)
        if before is not None:
            last_full = (before - 1) // self.full_state_every * self.full_state_every
            rows = rows.filter(F.col(BATCH) >= last_full)
        return rows.groupBy("session_id").agg(F.max_by("ended_in", BATCH).alias("ended_in"))

    def active(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/active", ACTIVE).select(*ACTIVE.names)

"""Active section per visit, with the state of each session kept by Spark.

A visit is a stretch of a session's events without a pause longer than ``idle_seconds``. The
sessions are dealt into ``BUCKETS`` by hash; the state of a bucket is one row in the RocksDB state
store, with the start, the newest event, the number of events and the section of each open
visit. A timer at the end of the first pause reports the visits that are over and removes them,
so the store holds the sessions that are still going on and no others.

A call gets what one batch holds of one bucket, sorted here; ``files_per_trigger`` of the source
bounds a batch. Where one session may be most of a stream, :class:`SectionTracking` cuts it
into chunks instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemark.operators.attribution import FIRST_ACTIVE, with_section
from tidemark.sources.sinks import read_batches, write_batch
from tidemark.streaming.triggers import start

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ACTIVE = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("session_id", LongType(), True),
        StructField("visit_start", TimestampType(), True),
        StructField("active_section", StringType(), True),
    ]
)
VISIT = StructType(
    [
        StructField("session_id", LongType(), True),
        StructField("visit_start", TimestampType(), True),
        StructField("visit_end", TimestampType(), True),
        StructField("n_events", LongType(), True),
        StructField("ended_in", StringType(), True),
    ]
)
#: Rows of both kinds in one stream, times in microseconds: those of events have an event id.
OUTPUT = (
    "event_id long, session_id long, start_us long, end_us long, n_events long, "
    "ended_in string, active_section string"
)
#: Open visits of a bucket: rows (session, start, newest, events) of numbers, and their sections.
STATE = "numbers binary, sections array<string>"
#: Buckets of sessions that share a row of state, at any number of sessions.
BUCKETS = 4096


def visit_tracker(idle_seconds: int):
    """Takes the rows of one batch of a bucket of sessions, or the end of a pause, and its state.

    What a call costs is shared by the bucket's sessions, which are worked on as arrays.
    """
    idle_us = idle_seconds * 1_000_000

    def track(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        numbers, sections = np.zeros((4, 0), np.int64), np.empty(0, object)
        if state.exists:
            data, listed = state.get
            numbers, sections = np.frombuffer(bytes(data), np.int64).reshape(4, -1), _objects(listed)
        if not state.hasTimedOut:
            events = pd.concat(list(parts))
            active, ended, (numbers, sections) = _followed(events, numbers, sections, idle_us)
            yield active
            yield _reports(*ended)
        # Milliseconds, after the last moment at which an event still belongs to a visit.
        over, now = (numbers[2] + idle_us) // 1000 + 1, state.getCurrentWatermarkMs()
        yield _reports(numbers[:, over < now], sections[over < now])
        goes_on = over >= now
        if goes_on.any():
            state.update((numbers[:, goes_on].tobytes(), sections[goes_on].tolist()))
            state.setTimeoutTimestamp(max(int(over[goes_on].min()), now + 1))
        elif state.exists:
            state.remove()

    return track


def _followed(events: pd.DataFrame, known: np.ndarray, known_in: np.ndarray, idle_us: int):
    """(rows of events, ended visits, open visits) after ``events``, from the visits open before."""
    session, at, ids = (events[c].to_numpy() for c in ("session_id", "at", "event_id"))
    order = np.lexsort((ids, at, session))
    session, at, ids = session[order], at[order], ids[order]
    sections = events["section_id"].to_numpy(object)[order]
    places = np.arange(len(at))
    head = np.r_[True, session[1:] != session[:-1]]
    # The open visit of each row's session, if there is one; -1 is none.
    visit_of = {own: k for k, own in enumerate(known[0].tolist())}
    heads = np.flatnonzero(head)
    before = np.array([visit_of.get(own, -1) for own in session[heads].tolist()])
    before = before[np.cumsum(head) - 1]
    newest = np.where(before >= 0, np.append(known[2], 0)[before], at)
    # An event older than its session's newest one comes as it comes, and is no pause.
    at = np.where(before >= 0, np.maximum(at, newest), at)
    last = np.where(head, newest, np.r_[0, at[:-1]])
    paused = at - last > idle_us
    begins = np.flatnonzero(head | paused)
    visit = np.cumsum(head | paused) - 1
    carried = np.where(head[begins] & ~paused[begins], before[begins], -1)
    starts = np.where(carried >= 0, np.append(known[1], 0)[carried], at[begins])
    # Where the newest row with a section is; a visit that goes on has the one it is in.
    placed = np.maximum.accumulate(np.where(pd.notna(sections), places, -1))
    sections = np.where(
        placed >= begins[visit], sections[placed], np.append(known_in, None)[carried][visit]
    )
    active = pd.DataFrame(
        {
            "event_id": ids,
            "session_id": session,
            "start_us": starts[visit],
            "end_us": None,
            "n_events": None,
            "ended_in": None,
            "active_section": np.where(pd.isna(sections), FIRST_ACTIVE, sections),
        }
    )
    ends = np.r_[begins[1:], len(at)] - 1
    sizes = ends + 1 - begins + np.where(carried >= 0, np.append(known[3], 0)[carried], 0)
    visits, visits_in = np.stack([session[begins], starts, at[ends], sizes]), sections[ends]
    newest_of = np.r_[head[begins[1:]], True]
    # Of the visits known before: ended by a pause, or of sessions without an event here.
    ended = before[head & paused]
    away = np.ones(known.shape[1], bool)
    away[before[before >= 0]] = False
    gone = np.c_[known[:, ended], visits[:, ~newest_of]], np.r_[known_in[ended], visits_in[~newest_of]]
    still = np.c_[known[:, away], visits[:, newest_of]], np.r_[known_in[away], visits_in[newest_of]]
    return active, gone, still


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _reports(visits: np.ndarray, visits_in: np.ndarray) -> pd.DataFrame:
    """Rows of ended visits."""
    session, starts, ends, sizes = visits
    return pd.DataFrame(
        {
            "event_id": None,
            "session_id": session,
            "start_us": starts,
            "end_us": ends,
            "n_events": sizes,
            "ended_in": [section or FIRST_ACTIVE for section in visits_in],
            "active_section": None,
        }
    )


@dataclass(frozen=True)
class VisitTracking:
    """Tables of one job under ``root``: the active section of each event, and ended visits.

    ``sections`` are rows of intervals, which become an expression of the stream."""

    spark: SparkSession
    root: str
    sections: list
    idle_seconds: int
    late_seconds: int = 0

    def start(self, events: DataFrame, every_seconds: int | None = None) -> StreamingQuery:
        """``events``: a stream of session_id, ts, event_id, scroll_y; ``ts`` a timestamp.

        Rows that come more than ``late_seconds`` after newer ones, and rows without a session
        or a time, are dropped.
        """
        self.spark.conf.set(STATE_STORE, ROCKSDB)
        real = events.where("session_id IS NOT NULL AND ts IS NOT NULL")
        placed = with_section(
            real.withWatermark("ts", f"{self.late_seconds} seconds"), self.sections
        )
        # ``ts`` carries the watermark; the times of day of the worker's zone are not used.
        tracked = (
            placed.select(
                F.expr(f"pmod(xxhash64(session_id), {BUCKETS})").alias("bucket"),
                F.col("session_id").cast("long"),
                "ts",
                F.unix_micros("ts").alias("at"),
                "event_id",
                "section_id",
            )
            .groupBy("bucket")
            .applyInPandasWithState(
                visit_tracker(self.idle_seconds),
                outputStructType=OUTPUT,
                stateStructType=STATE,
                outputMode="append",
                timeoutConf=GroupStateTimeout.EventTimeTimeout,
            )
            .withColumn("visit_start", F.timestamp_micros("start_us"))
            .withColumn("visit_end", F.timestamp_micros("end_us"))
        )
        return start(tracked, self.on_batch, f"{self.root}/_stream", every_seconds)

    def on_batch(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            event = F.col("event_id").isNotNull()
            write_batch(rows.where(event).select(*ACTIVE.names), f"{self.root}/active", batch_id)
            write_batch(rows.where(~event).select(*VISIT.names), f"{self.root}/visits", batch_id)
        finally:
            rows.unpersist()

    def active(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/active", ACTIVE).select(*ACTIVE.names)

    def visits(self) -> DataFrame:
        """Visits that are over; those still going on are only in the state."""
        return read_batches(self.spark, f"{self.root}/visits", VISIT).select(*VISIT.names)

"""Market refresh (T1-T8): whole snapshots replace each other, the last good one stays.

The input is a log of fetch attempts; each row names the folder or file its body
landed in. A snapshot may thus have any number of files, and an empty one still counts.

What is shown is told by a manifest: one row per batch, which carries the last good batch
forward. A batch reads the manifest of the batch before it and nothing else of the past; its own
manifest, one file that is there or not, is written last and makes its work visible. Snapshots
that no manifest leads to any more are removed, so the folders do not grow with the age of
the job. The status table keeps the story of all batches and is only read on demand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemark.operators.market import kpi_texts, kpi_totals, retain_selected
from tidemark.schemas import CORRUPT, FETCH_LOG, MARKET
from tidemark.session import remove_dir
from tidemark.sources.readers import is_corrupt, read_market_checked
from tidemark.sources.sinks import BATCH, read_batches, read_if_written, write_batch
from tidemark.streaming.triggers import REFRESH_SECONDS, start

STATUS = StructType(
    [
        StructField("good", BooleanType(), True),
        StructField("fetched_at", TimestampType(), True),
        StructField("asset_count", LongType(), True),
        StructField("error", StringType(), True),
    ]
)
#: What is shown after a batch, and what was shown before that.
MANIFEST = StructType(
    [
        StructField("shown_batch", LongType(), True),
        StructField("fetched_at", TimestampType(), True),
        StructField("asset_count", LongType(), True),
        StructField("before_batch", LongType(), True),
    ]
)
QUARANTINE = StructType(
    [StructField("path", StringType(), True), StructField("record", StringType(), True)]
)


@dataclass(frozen=True)
class MarketRefresh:
    """Tables of one refresh job under ``root``, and how bodies are read."""

    spark: SparkSession
    root: str
    array_files: bool = True

    def start(
        self, log_path: str, every_seconds: int | None = REFRESH_SECONDS, files_per_trigger: int = 1
    ) -> StreamingQuery:
        log = (
            self.spark.readStream.schema(FETCH_LOG)
            .option("maxFilesPerTrigger", files_per_trigger)
            .json(log_path)
        )
        return start(log, self.on_batch, f"{self.root}/_stream", every_seconds)

    def on_batch(self, attempts: DataFrame, batch_id: int) -> None:
        """Apply the newest good attempt of the batch, if it is newer than what is shown."""
        before = self._manifest(batch_id - 1)
        shown = before if before is not None and before["shown_batch"] is not None else None
        newest_first = attempts.orderBy(F.desc("fetched_at"), F.desc("fetch_id"))
        error, good = None, None
        # Attempts are few per batch; the first good one ends the walk, older ones are outdated.
        for attempt in newest_first.toLocalIterator():
            if attempt["fetched_at"] is None:
                error = error or attempt["error"] or "Fetch without a time."
                continue
            if shown is not None and attempt["fetched_at"] <= shown["fetched_at"]:
                break
            problem, rows = self._load(attempt, batch_id)
            if problem is None:
                self._show(batch_id, shown)
                good = (batch_id, attempt["fetched_at"], rows)
                break
            error = error or problem
        self._report(batch_id, good is not None, *(good or (None, None, None))[1:], error)
        if good:
            now = (*good, shown["shown_batch"] if shown else None)
        else:
            now = tuple(before) if before is not None else (None,) * len(MANIFEST)
        self._write_row(MANIFEST, now, "manifest", batch_id)
        self._remove_unreachable(batch_id, before, now[0])

    def _manifest(self, batch_id: int) -> Row | None:
        """What was shown after a batch; None before the first one."""
        rows = read_if_written(self.spark, f"{self.root}/manifest/{BATCH}={batch_id}", MANIFEST)
        return None if rows is None else rows.first()

    def _remove_unreachable(self, batch_id: int, before: Row | None, shown: int | None) -> None:
        """A repeat of this batch needs the manifest before it; readers may still hold the
        snapshot shown before. What that one replaced is out of reach, as is a body not shown."""
        if shown != batch_id:
            remove_dir(self.spark, f"{self.root}/loaded/{BATCH}={batch_id}")
        elif before is not None and before["before_batch"] is not None:
            old = before["before_batch"]
            for table, version in (("loaded", old), ("kpis", old), ("selected", old + 1)):
                remove_dir(self.spark, f"{self.root}/{table}/{BATCH}={version}")
        remove_dir(self.spark, f"{self.root}/manifest/{BATCH}={batch_id - 2}")

    def _load(self, attempt: Row, batch_id: int) -> tuple[str | None, int]:
        """Write the body as this batch's snapshot; a problem text if it must not be shown."""
        if attempt["error"]:
            return attempt["error"], 0
        if attempt["status"] is None or not 200 <= attempt["status"] < 300:
            return f"Request failed with status {attempt['status']}.", 0
        try:
            body = read_market_checked(self.spark, attempt["path"], self.array_files)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return "Body not found.", 0
        marked = body.withColumn("corrupt", is_corrupt())
        # One parse: the counts come from what was written. Readers follow the status
        # table, so they do not see this folder yet.
        write_batch(marked, f"{self.root}/loaded", batch_id)
        loaded = self._loaded(batch_id)
        count = loaded.agg(F.count("*").alias("n"), F.count_if("corrupt").alias("bad")).first()
        if count["bad"] == 0:
            return None, count["n"]
        bad = loaded.filter("corrupt").select(
            F.lit(attempt["path"]).alias("path"), F.col(CORRUPT).alias("record")
        )
        write_batch(bad, f"{self.root}/quarantine", batch_id)
        return f"{count['bad']} unreadable records", 0

    def _loaded(self, batch_id: int) -> DataFrame:
        fields = [
            *MARKET.fields,
            StructField(CORRUPT, StringType(), True),
            StructField("corrupt", BooleanType(), True),
        ]
        return self.spark.read.schema(StructType(fields)).parquet(
            f"{self.root}/loaded/{BATCH}={batch_id}"
        )

    def _show(self, batch_id: int, shown: Row | None) -> None:
        """Derived tables of a snapshot: its KPIs (T5) and the kept selections."""
        snapshot = self._loaded(batch_id).select(*MARKET.names)
        write_batch(kpi_totals(snapshot), f"{self.root}/kpis", batch_id)
        old = self._selected_as_of(shown)
        if old is not None:
            kept = retain_selected(old, snapshot)
            write_batch(kept.select(*MARKET.names), f"{self.root}/selected", batch_id + 1)

    def _report(self, batch_id: int, good: bool, fetched_at, rows, error) -> None:
        self._write_row(STATUS, (good, fetched_at, rows, error), "status", batch_id)

    def _write_row(self, schema: StructType, values: tuple, table: str, batch_id: int) -> None:
        typed = zip(schema.fields, values, strict=True)
        row = self.spark.range(1, numPartitions=1).select(
            *[F.lit(value).cast(field.dataType).alias(field.name) for field, value in typed]
        )
        write_batch(row, f"{self.root}/{table}", batch_id)

    def status(self) -> DataFrame:
        """One row per batch: good or not, freshness stamp (T6), rows, error."""
        return read_batches(self.spark, f"{self.root}/status", STATUS)

    def quarantined(self) -> DataFrame:
        """Unreadable records with the body they came from."""
        return read_batches(self.spark, f"{self.root}/quarantine", QUARANTINE)

    def _last_good(self) -> Row | None:
        """What is shown now, by the newest of the few manifests there are."""
        rows = read_batches(self.spark, f"{self.root}/manifest", MANIFEST)
        newest = rows.orderBy(F.desc(BATCH)).limit(1).collect()
        return newest[0] if newest and newest[0]["shown_batch"] is not None else None

    def current(self) -> DataFrame:
        """The shown snapshot (S10): rows of the last good batch only."""
        last = self._last_good()
        if last is None:
            return self.spark.createDataFrame([], MARKET)
        return self._loaded(last["shown_batch"]).select(
            *MARKET.names, F.lit(last["fetched_at"]).alias("fetched_at")
        )

    def current_kpis(self) -> DataFrame | None:
        """KPIs of the shown snapshot; the numbers are stored, the texts made here."""
        last = self._last_good()
        if last is None:
            return None
        return kpi_texts(self.spark.read.parquet(f"{self.root}/kpis/{BATCH}={last['shown_batch']}"))

    def select(self, rows: DataFrame) -> None:
        """Store selected assets (M3) before the job starts; each refresh updates them."""
        write_batch(rows.select(*MARKET.names), f"{self.root}/selected", 0)

    def selected(self) -> DataFrame | None:
        """Selected assets as of the shown snapshot; None if nothing was selected."""
        return self._selected_as_of(self._last_good())

    def _selected_as_of(self, shown: Row | None) -> DataFrame | None:
        """Version 0 is the selection as stored; batch n writes version n + 1."""
        version = 0 if shown is None else shown["shown_batch"] + 1
        return read_if_written(
            self.spark, f"{self.root}/selected/{BATCH}={version}", MARKET
        )

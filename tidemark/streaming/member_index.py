"""Keys of all members known to a stream, as a log of small changes over merged versions.

Each batch writes the key counts of the members it accepted as one change. Every so many
batches the changes are merged into a new full version, sorted by key. A batch reads the newest
full version before it and the changes since, whose folders follow from its number: nothing is
listed, and the folders read do not grow with the age of the stream. Folders no batch can
read any more are removed.

A batch reads only what earlier batches wrote and writes only folders of its own, so it can be
repeated at any point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators.identity import add_key_counts, key_counts
from tidemark.operators.key_filter import may_be_in
from tidemark.session import remove_dir

#: Batches between two full versions: a batch reads so many folders of changes at most.
MERGE_EVERY = 10

COUNTS = StructType(
    [StructField("member_key", StringType(), True), StructField("n", LongType(), True)]
)


@dataclass(frozen=True)
class MemberIndex:
    """Index under ``root``. Full version -1 holds the members known before the stream."""

    spark: SparkSession
    root: str
    base_members: DataFrame | None = None
    merge_every: int = MERGE_EVERY

    def _full(self, version: int) -> str:
        return f"{self.root}/full/upto={version}"

    def _change(self, batch_id: int) -> str:
        return f"{self.root}/change/batch={batch_id}"

    def newest_full(self, before: int) -> int:
        """The newest full version that a batch may read: full ones hold whole batches."""
        return -1 if before <= 0 else (before - 1) // self.merge_every * self.merge_every

    def open(self, batch_id: int) -> None:
        """Before the first batch: the one scan of the members known before."""
        if batch_id:
            return
        if self.base_members is None:
            known = self.spark.createDataFrame([], COUNTS)
        else:
            known = key_counts(self.base_members)
        self._write_full(known, -1)

    def folders(self, before: int) -> list[str]:
        """What a batch reads: one full version and the changes since."""
        full = self.newest_full(before)
        return [self._full(full), *map(self._change, range(full + 1, before))]

    def counts(self, before: int, keys: DataFrame | None = None) -> DataFrame:
        """``(member_key, n)`` of the members before a batch; with ``keys`` (``key``) only of
        those that may be among them, sorted out as the files are read."""
        parts = self.spark.read.schema(COUNTS).parquet(*self.folders(before))
        if keys is not None:
            parts = parts.where(may_be_in(keys, "key", "member_key"))
        return add_key_counts(parts)

    def add(self, members: DataFrame, batch_id: int) -> None:
        """Record what a batch accepted; every ``merge_every`` batches merge all there is."""
        key_counts(members).write.mode("overwrite").parquet(self._change(batch_id))
        if batch_id % self.merge_every == 0:
            known = [*self.folders(batch_id), self._change(batch_id)]
            merged = add_key_counts(self.spark.read.schema(COUNTS).parquet(*known))
            self._write_full(merged, batch_id)
            self._remove_before(self.newest_full(batch_id))

    def _write_full(self, counts: DataFrame, version: int) -> None:
        ordered = counts.repartitionByRange("member_key").sortWithinPartitions("member_key")
        ordered.write.mode("overwrite").parquet(self._full(version))

    def _remove_before(self, version: int) -> None:
        """Folders that only batches up to ``version`` read; later ones begin with that version."""
        if version < 0:
            return
        older = self.newest_full(version)
        for folder in (self._full(older), *map(self._change, range(older + 1, version + 1))):
            remove_dir(self.spark, folder)

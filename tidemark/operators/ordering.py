"""Whole-table order work that never puts one table or one group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

CHUNK = "__chunk"
POSITION = "__position"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def ordered_chunks(df: DataFrame, *order: Column | str) -> DataFrame:
    """Range-partition by a unique order, so every chunk has about the same size.

    Adds the chunk number, which follows the order, and the row's place in its chunk.
    The result is checkpointed: later jobs over it must all see the same chunks, and
    the range bounds come from a sample.
    """
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(POSITION, place)
        .withColumn(CHUNK, F.shiftright(F.col(POSITION), _ROW_BITS).cast("int"))
        .withColumn(POSITION, F.col(POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    return cut_lineage(placed)


def global_row_number(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Row number over the whole table (WN3), from 1. The order must be unique.

    A window without partition keys would sort the table in one task. Here each chunk
    counts its own rows, and only one number per chunk is added up on the driver.
    """
    placed = ordered_chunks(df, *order)
    sizes = sorted(placed.groupBy(CHUNK).count().collect())
    offsets, total = [], 0
    for chunk, rows in sizes:
        offsets.append((chunk, total))
        total += rows
    starts = df.sparkSession.createDataFrame(offsets, f"{CHUNK} int, __start long")
    return (
        placed.join(F.broadcast(starts), CHUNK)  # one row per chunk
        .withColumn(name, F.col("__start") + F.col(POSITION) + 1)
        .drop(CHUNK, POSITION, "__start")
    )


def carry_forward(
    df: DataFrame, group: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Last non-null ``value`` up to each row of its group; null before the first (WN1).

    All groups are range-partitioned together by their order, so a group of any size lies
    in as many chunks as it fills. A running window carries the value within a chunk, and
    each chunk of a group starts from what the group's chunks before it end with.
    ``group`` + ``order`` must be unique.
    """
    chunks = ordered_chunks(df, group, *order).drop(POSITION)
    # One row per chunk and group: what the group's part of the chunk ends with.
    ends = chunks.groupBy(group, CHUNK).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("__end")
    )
    before = (
        Window.partitionBy(group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ends.select(
        F.col(group).alias("__group"),
        F.col(CHUNK).alias("__of"),
        F.last("__end", ignorenulls=True).over(before).alias("__start"),
    )
    running = (
        Window.partitionBy(group, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    inside = chunks.withColumn(name, F.last(value, ignorenulls=True).over(running))
    joined = inside.join(
        starts, inside[group].eqNullSafe(starts["__group"]) & (inside[CHUNK] == starts["__of"])
    )
    return joined.withColumn(name, F.coalesce(name, "__start")).drop(
        CHUNK, "__group", "__of", "__start"
    )

"""Joins to tables of unique keys, in a form whose hot keys adaptive execution can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_key(first: str, second: str) -> str:
    """Two texts as one key; the length keeps different pairs apart. Null if either is."""
    return f"concat(length({first}), ':', {first}, {second})"


def pair_text(first: str, second: str) -> str:
    """Two texts, null or not, as one key that is never null."""
    return (
        f"concat(coalesce(concat(length({first}), ':', {first}), 'n'), "
        f"coalesce(concat('=', {second}), 'n'))"
    )


def lookup(
    rows: DataFrame, table: DataFrame, key: str, table_key: str, how: str = "left"
) -> DataFrame:
    """Left, inner, semi or anti join of ``rows`` to ``table``, whose keys are unique.

    The keys are SQL expressions; the table's key columns are its own names, and stay.
    Spark splits a hot key only when both join inputs are plain shuffles. A table that
    was just aggregated by the key is shuffled by it already and would be joined in
    place, so the key is tagged on both sides: the table, one row per key, is shuffled
    once more, and the rows of a hot key go to several tasks.
    """
    tagged = table.withColumn("__key", F.expr(f"concat('=', {table_key})"))
    joined = rows.join(tagged, F.expr(f"concat('=', {key})") == F.col("__key"), how)
    return joined.drop("__key")

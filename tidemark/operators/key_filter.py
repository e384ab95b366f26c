"""Bit filters of fixed size: rows that cannot match are dropped before they are shuffled.

A filter only spares work. What passes it is joined exactly later, so a full filter, as of a
very large set of keys, costs nothing but the sparing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter, whatever the number of its keys: 16 KiB words at most on the driver.
FILTER_BITS = 1 << 17


def _bit(key: str, bits: int) -> str:
    return f"pmod(xxhash64({key}), {bits}L)"


def may_be_in(keys: DataFrame, key: str, column: str, bits: int = FILTER_BITS) -> Column:
    """Condition that holds wherever ``column`` is a value of ``key`` in ``keys``, and seldom else."""
    words = (
        keys.select(F.expr(_bit(key, bits)).alias("b"))
        .groupBy(F.expr("shiftright(b, 6)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 AS int)))").alias("set"))
        .collect()
    )
    # One number per 64 bits: at most FILTER_BITS / 64 rows come to the driver.
    table = [0] * (bits // 64)
    for word, mask in words:
        table[word] = mask
    listed = ",".join(map(str, table))
    # A cast of a constant is one itself; a lambda would be run for every row.
    held = f"cast(split('{listed}', ',') AS array<bigint>)"
    bit = _bit(column, bits)
    return F.expr(
        f"getbit(element_at({held}, cast(shiftright({bit}, 6) AS int) + 1), "
        f"cast({bit} & 63 AS int)) = 1"
    )

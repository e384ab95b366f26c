"""SQL text helpers.

The column functions of this package are templates of SQL text, parsed once per call by
Spark. An operand is a column name or any SQL expression. Built call by call through the
Python column API, the larger ones would take seconds before the job even starts.
"""

from __future__ import annotations


def quoted(text: str) -> str:
    """A SQL string literal of exactly this text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\0", "\\0")
    return f"'{escaped}'"


def in_list(texts) -> str:
    return "(" + ", ".join(quoted(t) for t in texts) + ")"


def case(branches, otherwise: str) -> str:
    """``CASE`` over (condition, value) pairs."""
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {otherwise} END"

"""Number, rank and time text as native expressions.

Rounding comes first and the print pattern second: ``round`` goes half away from
zero on the shortest decimal, while a print pattern alone would send ties to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.sqltext import case, quoted

MISSING = "N/A"

# Unit sizes and their suffixes, smallest first.
UNITS = (("1D", ""), ("1e3D", "K"), ("1e6D", "M"), ("1e9D", "B"), ("1e12D", "T"))


def _double(operand: str) -> str:
    return f"CAST(({operand}) AS DOUBLE)"


def _or_missing(v: str, text: str) -> Column:
    return F.expr(case([(f"{v} IS NULL OR isnan({v})", quoted(MISSING))], text))


def _minus(v: str) -> str:
    return f"CASE WHEN {v} < 0 THEN '-' ELSE '' END"


def _compact(v: str, short: str, grouped: str) -> str:
    """Scale by the first unit whose *rounded* quotient stays below 1000; the last takes the rest.

    A quotient rounds to 1000.00 from 999.995 on, so one comparison per unit finds the
    unit, and only the chosen quotient is rounded. The pattern groups from 10,000 on.
    """
    *smaller, (last_size, last_suffix) = UNITS
    fits = [(f"{v} / {size} < 999.995D", size, suffix) for size, suffix in smaller]
    size = case([(test, size) for test, size, _ in fits], last_size)
    suffix = case([(test, quoted(suffix)) for test, _, suffix in fits], quoted(last_suffix))
    pattern = case([(f"{v} / {last_size} >= 9999.995D", quoted(grouped))], quoted(short))
    return f"concat(format_number(round({v} / {size}, 2), {pattern}), {suffix})"


def format_compact_currency(value: str) -> Column:
    """``$1.23K`` from 1 up; below 1 (zero and negatives too) plain dollars with 2 to 6 decimals."""
    v = _double(value)
    plain = f"concat({_minus(v)}, '$', format_number(round(abs({v}), 6), '#,##0.00####'))"
    compact = f"concat('$', {_compact(v, '0.00', '#,##0.00')})"
    return _or_missing(v, case([(f"{v} < 1", plain)], compact))


def format_percent(value: str) -> Column:
    """Signed, two decimals of the exact binary value; an exact tie goes away from zero.

    A double sits exactly between two cents only when eight times it is odd. Adding
    zero turns a minus zero into a plain one.
    """
    v = f"({_double(value)} + 0D)"
    digits = case(
        [(f"abs({v} * 8) % 2 = 1", f"format_string('%.2f', {v})")], f"format_number({v}, '0.00')"
    )
    return _or_missing(v, f"concat(CASE WHEN {v} >= 0 THEN '+' ELSE '' END, {digits}, '%')")


def format_number(value: str) -> Column:
    """Grouped, at most three decimals."""
    v = _double(value)
    return _or_missing(
        v, f"concat({_minus(v)}, format_number(round(abs({v}), 3), '#,##0.###'))"
    )


def format_supply(value: str, symbol: str) -> Column:
    """Compact amount with at most two decimals, then the upper-case symbol."""
    v = _double(value)
    digits = _compact(f"abs({v})", "0.##", "#,##0.##")
    return _or_missing(v, f"concat({_minus(v)}, {digits}, ' ', upper({symbol}))")


def upper_symbol(symbol: str) -> Column:
    return F.upper(F.expr(symbol))


def rank_text_detail(rank: str) -> Column:
    """``#1,234``; ``#N/A`` without a rank."""
    return F.concat(F.lit("#"), format_number(rank))


def rank_text_table(rank: str) -> Column:
    """``#1234``; a bare ``#`` without a rank."""
    return F.expr(f"concat('#', coalesce(CAST({rank} AS STRING), ''))")


def refresh_time_text(ts: str) -> Column:
    """Clock time in the session time zone; ``pending`` before the first refresh."""
    return F.expr(f"coalesce(date_format({ts}, 'h:mm:ss a'), 'pending')")


def join_present(*values: str) -> Column:
    """Space-joined texts without the null and empty ones."""
    texts = ", ".join(f"nullif({value}, '')" for value in values)
    return F.expr(f"concat_ws(' ', {texts})")

"""Text cleansing of form input and of search text (C1-C7), over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.sqltext import quoted

BS = "\\"

# What each trim strips.
FORM_BLANKS = " \t\n\r\0\x0b"
SEARCH_BLANKS = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Markup characters and their escapes, the ampersand first.
MARKUP_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
SINGLE_QUOTE_ESCAPE = ("'", "&#039;")

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

# A backslash-zero whose backslash is not itself escaped: an even run comes before it.
_NUL_MARK = r"(?<!\\)((?:\\\\)*)\\0"
_ESCAPED = r"(?s)\\(.?)"


def search_normalise(text: str) -> Column:
    """Strip every Unicode white space and the byte order mark from both ends, then lower."""
    return F.expr(f"lower(btrim({text}, {quoted(SEARCH_BLANKS)}))")


def form_trim_sql(text: str) -> str:
    return f"btrim({text}, {quoted(FORM_BLANKS)})"


def strip_slashes_sql(text: str) -> str:
    r"""Drop each escaping backslash: ``\\`` gives one, ``\0`` gives NUL.

    Only texts with one of those two need the patterns; single marks just go.
    """
    one, two, nul = quoted(BS), quoted(BS + BS), quoted(BS + "0")
    marked = f"regexp_replace({text}, {quoted(_NUL_MARK)}, {quoted('$1' + chr(0))})"
    return (
        f"CASE WHEN NOT contains({text}, {one}) THEN {text} "
        f"WHEN contains({text}, {two}) OR contains({text}, {nul}) "
        f"THEN regexp_replace({marked}, {quoted(_ESCAPED)}, '$1') "
        f"ELSE replace({text}, {one}, '') END"
    )


def escape_markup_sql(text: str, escape_single_quote: bool = True) -> str:
    """Escape markup; text that is escaped already is escaped again."""
    escapes = MARKUP_ESCAPES + ((SINGLE_QUOTE_ESCAPE,) if escape_single_quote else ())
    for plain, escaped in escapes:
        text = f"replace({text}, {quoted(plain)}, {quoted(escaped)})"
    return text


def clean_unescaped_sql(text: str) -> str:
    return strip_slashes_sql(form_trim_sql(text))


def clean_input_sql(text: str, escape_single_quote: bool = True) -> str:
    """Trim, then unslash, then escape: the order matters, and rules see the result."""
    return escape_markup_sql(clean_unescaped_sql(text), escape_single_quote)


def is_empty_sql(raw: str) -> str:
    """Missing, ``''`` or ``'0'``, judged before any trimming."""
    return f"({raw} IS NULL OR {raw} IN ('', '0'))"


def clean_or_blank_sql(raw: str, escape_single_quote: bool = True) -> str:
    """Cleansed text, or ``''`` where the raw value counts as empty."""
    cleansed = clean_input_sql(raw, escape_single_quote)
    return f"CASE WHEN {is_empty_sql(raw)} THEN '' ELSE {cleansed} END"


def lower_email_sql(text: str) -> str:
    """Lower the ASCII letters only, so no other letter turns into an ASCII one."""
    return f"translate({text}, '{ASCII_UPPER}', '{ASCII_LOWER}')"


def clean_input(text: str, escape_single_quote: bool = True) -> Column:
    return F.expr(clean_input_sql(text, escape_single_quote))


def clean_or_blank(raw: str, escape_single_quote: bool = True) -> Column:
    return F.expr(clean_or_blank_sql(raw, escape_single_quote))


def lower_email(text: str) -> Column:
    return F.expr(lower_email_sql(text))


def digest(text: str) -> Column:
    return F.expr(f"sha2({text}, 256)")

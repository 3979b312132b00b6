"""Text repair, extraction and key building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decimal_comma_cents(col: Column | str) -> Column:
    """``"12,34"`` to 1234; NULL if the text is not a number of up to 16 digits before the comma."""
    number = F.regexp_replace(_c(col).cast("string"), ",", ".").try_cast("decimal(18,2)")
    return (number * 100).cast("bigint")


def parse_day_or_minute(col: Column | str, clock: str) -> Column:
    """``dd/MM/yyyy`` (completed with ``clock``) or ``dd/MM/yyyy HH:mm``."""
    text = F.when(F.length(_c(col)) == 10, F.concat_ws(" ", _c(col), F.lit(clock))).otherwise(_c(col))
    return F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm"))


def repair_timestamp(col: Column | str) -> Column:
    """Add the missing seconds to a 17 character timestamp text."""
    c = _c(col)
    return F.when(F.length(c) == 17, F.concat(F.substring(c, 1, 16), F.lit(":00Z"))).otherwise(c)


def attempt_number(col: Column | str, tag: str = "ATTEMPT_") -> Column:
    """Number after a tag such as ``ATTEMPT_``; NULL without one."""
    return F.regexp_extract(_c(col), f"{tag}([0-9]+)", 1).try_cast("int")


def strip_prefix(col: Column | str, prefix: str) -> Column:
    c = _c(col)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def after_mark(col: Column | str, mark: str = "@") -> Column:
    """Text after the first mark; NULL when the mark is missing."""
    c = _c(col)
    return F.when(F.instr(c, mark) > 0, F.substr(c, F.instr(c, mark) + F.lit(len(mark))))


def digits_only(col: Column | str) -> Column:
    return _c(col).rlike("^[0-9]+$")


def no_digits(col: Column | str) -> Column:
    return _c(col).rlike("^[^0-9]+$")


def postcode(col: Column | str, zone: str = "ZONE") -> Column:
    """Zero-pad postcodes to five characters, leave zone names alone."""
    c = _c(col).cast("string")
    return F.when(c.startswith(zone), c).otherwise(F.lpad(c, 5, "0"))


def sheet_text(col: Column | str) -> Column:
    """Prefix with an apostrophe so that spreadsheets keep the text as it is."""
    return F.concat(F.lit("'"), _c(col).cast("string"))


def flatten_row(df: DataFrame, sep: str, cols: Sequence[str] | None = None, missing: str = "-") -> Column:
    """All columns as one delimited text without line breaks."""
    parts = [
        F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit(missing)), r"[\r\n]+", " ")
        for c in (cols or df.columns)
    ]
    return F.concat_ws(sep, *parts)


def filled(col: Column | str, missing: str) -> Column:
    """Trimmed single-line text with a fill for NULL and blank."""
    c = F.regexp_replace(F.trim(_c(col).cast("string")), r"[\r\n]+", " ")
    return F.when(c.isNull() | (c == ""), F.lit(missing)).otherwise(c)

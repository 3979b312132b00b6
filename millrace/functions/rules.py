"""Ordered rules compiled to columns.

A rule list is data: it can be read, versioned by name and tested. These
helpers turn one into a single first-match expression.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition is true; NULL counts as no match."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, _lit(value)) if chain is None else chain.when(condition, _lit(value))
    return _lit(default) if chain is None else chain.otherwise(_lit(default))


def prefix_label(col: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: Column | str | None) -> Column:
    """Label by text prefix, in rule order.

    ``rules`` is ``[(label, [prefix, ...]), ...]``; ``default`` is a column
    (for example the value already recorded) or a literal label.
    """
    text = F.col(col) if isinstance(col, str) else col
    conditions = [
        (reduce(lambda a, b: a | b, [text.startswith(p) for p in prefixes]), label) for label, prefixes in rules
    ]
    return first_match(conditions, default)


def code_text(col: Column | str, texts: Mapping[str, str], default: str) -> Column:
    """Text of a trimmed code from a literal dictionary."""
    code = F.trim(F.col(col) if isinstance(col, str) else col)
    return first_match([(code == k, v) for k, v in texts.items()], default)


def band_code(col: Column | str, bands: Sequence[tuple[int, int, int]]) -> Column:
    """Code of the closed range ``(code, low, high)`` that holds the value."""
    value = F.col(col) if isinstance(col, str) else col
    return first_match([((value >= lo) & (value <= hi), code) for code, lo, hi in bands])


def flag(condition: Column) -> Column:
    """1 if the condition is true, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def any_flag(cols: Sequence[str]) -> Column:
    return flag(reduce(lambda a, b: a | b, [F.col(c) == 1 for c in cols]))


def error_list(flags: Mapping[str, str], sep: str = ", ") -> Column:
    """Texts of the raised flags joined in order; empty text if none."""
    return F.concat_ws(sep, *[F.when(F.col(c) == 1, F.lit(text)) for c, text in flags.items()])

"""Amounts in whole cents, ratios and capped fees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col: Column | str) -> Column:
    """Amount to whole cents, rounded half up in decimal arithmetic."""
    return F.round(_c(col).cast("decimal(18,4)") * 100, 0).cast("bigint")


def half_up_div(numerator: Column, denominator: Column | int) -> Column:
    """Whole-number division rounded half up, for amounts >= 0."""
    d = F.lit(denominator) if isinstance(denominator, int) else denominator
    n = numerator.cast("bigint")
    return F.call_function("div", n * 2 + d, d * 2).cast("bigint")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL when the denominator is zero."""
    return num / F.nullif(den, F.lit(0))


def proportional_fee(cost_cents: Column, late: Column, span: int, cap_at: int | None = None, cap_times: int = 1) -> Column:
    """Fee in cents that grows with lateness.

    ``cost * late / span`` rounded half up, fixed at ``cap_times * cost`` from
    ``cap_at`` days on (by default from ``span``).
    """
    limit = span if cap_at is None else cap_at
    return F.when(late < limit, half_up_div(cost_cents * late, span)).when(late >= limit, cost_cents * cap_times)


def allowance_fee(late: Column, total: Column, allowance: float, fee: float) -> tuple[Column, Column]:
    """(share late beyond the allowance, floored at 0; fee over the total)."""
    share = F.greatest(late / total - F.lit(allowance), F.lit(0.0))
    return share, share * total * F.lit(fee)


def stepped_fee(late: Column, first_days: int, first_rate: int, later_rate: int) -> Column:
    """``first_rate`` per day up to ``first_days``, ``later_rate`` after."""
    base = F.lit(first_days * first_rate)
    return F.when(late <= first_days, late * first_rate).when(
        late > first_days, base + (late - first_days) * later_rate
    )

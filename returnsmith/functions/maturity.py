"""Coded maturities: the integer 10MMDDD = 1000000 + months * 1000 + days, 1060DDD from 5 years on."""

from __future__ import annotations

FIVE_YEARS = 1060000
ONE_YEAR = 1012000
ON_DEMAND = 1001000

# report buckets, open below and closed above; the last has no upper end (fixed values)
BUCKETS = (
    ("le_3m", 1000000, 1003000),
    ("m3_12m", 1003000, 1012000),
    ("y1_2y", 1012000, 1024000),
    ("y2_5y", 1024000, 1060000),
    ("ge_5y", 1060000, None),
)


def tenor_code(start: str, end: str) -> str:
    """Maturity code of the days between two dates: whole years of 365 days, months of
    30 days, and the days left over after the whole years. Missing or negative: null."""
    days = f"datediff({end}, {start})"
    return (f"CAST(CASE WHEN {days} >= 5 * 365 THEN {FIVE_YEARS} + {days} % 365 "
            f"WHEN {days} >= 0 THEN 1000000 + {days} div 30 * 1000 + {days} % 365 END AS int)")


def in_bucket(code: str, low: int, high: int | None) -> str:
    return f"{code} > {low}" if high is None else f"({code} > {low} AND {code} <= {high})"

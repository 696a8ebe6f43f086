"""Rounded averages and guarded ratios on exact decimals (half away from zero)."""

from __future__ import annotations


def _exact(value: str) -> str:
    return f"cast({value} AS decimal(20,0))"


def rounded_mean(total: str, rows: str) -> str:
    """Mean of integers to two places, from their sum and their count.

    Integer sums keep the mean exact; averaging doubles first could move a tie.
    """
    return f"cast(round({_exact(total)} / {_exact(rows)}, 2) AS decimal(10,2))"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` to four places; NULL unless ``whole`` is positive."""
    quotient = f"cast(round({_exact(part)} / {_exact(whole)}, 4) AS decimal(8,4))"
    return f"if({whole} > 0, {quotient}, NULL)"


def exceeds(peak: str, capacity: str) -> str:
    """True only where a positive capacity is exceeded; never NULL."""
    return f"coalesce({capacity} > 0 AND {peak} > {capacity}, false)"


def rounded_total(value: str) -> str:
    """Sum of decimals, rounded half up to a whole number."""
    return f"cast(round(sum({value})) AS bigint)"

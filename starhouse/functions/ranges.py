"""Right-sided range partition numbers over integer keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_starts(first: int, last: int) -> list[int]:
    """yyyymmdd keys of every month start from month ``first`` to ``last`` (yyyymm)."""
    lo, hi = (m // 100 * 12 + m % 100 - 1 for m in (first, last))
    return [(n // 12 * 100 + n % 12 + 1) * 100 + 1 for n in range(lo, hi + 1)]


def range_right(key: Column, boundaries: Sequence[int]) -> Column:
    """1 + the number of boundaries at or below the key.

    A boundary belongs to the partition on its right; keys below the first
    boundary fall in partition 1, keys from the last one on in the final one.
    """
    steps = F.array(*[F.lit(b) for b in sorted(boundaries)])
    return F.size(F.filter(steps, lambda b: b <= key)) + 1

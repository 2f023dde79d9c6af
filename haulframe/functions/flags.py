"""Business flags. A missing input gives False, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses that count as expedited, and the high-value limit.
EXPEDITED = ("in_transit", "delivered")
HIGH_VALUE = 50_000


def is_expedited(status: str) -> Column:
    """Compared in lower case, so it works before and after case standardisation."""
    return F.when(F.lower(F.col(status)).isin(*EXPEDITED), True).otherwise(False)


def is_high_value(cost: str, limit: float = HIGH_VALUE) -> Column:
    return F.when(F.col(cost) > limit, True).otherwise(False)

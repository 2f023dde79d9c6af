"""Sorting, top-k and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_total(df: DataFrame, order: list[Column], tie_break: str) -> DataFrame:
    """Sort with a unique last key: repeatable, and equal values can be spread over many tasks."""
    return df.orderBy(*order, F.col(tie_break).asc())


def top_k(df: DataFrame, order: list[Column], tie_break: str, k: int) -> DataFrame:
    """Each task keeps k rows; only those are merged."""
    return df.orderBy(*order, F.col(tie_break).asc()).limit(k)


def sample_by_key(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """A repeatable sample: a row is in when the hash of its key falls under the fraction.

    Unlike ``DataFrame.sample`` it does not depend on the partitioning of the input.
    """
    limit = f"{round(fraction * 16**8):08x}"
    return df.where(F.substring(F.md5(F.col(key).cast("string")), 1, 8) < limit)

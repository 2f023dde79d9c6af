"""Set operations by row value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _membership(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row once, with two flags: it is in the first, in the second.

    Repeats are combined before the one shuffle this takes, and null values match null values.
    """
    both = a.withColumn("_second", F.lit(False)).unionByName(b.withColumn("_second", F.lit(True)))
    return both.groupBy(*a.columns).agg(
        F.bool_or(~F.col("_second")).alias("_in_a"), F.bool_or("_second").alias("_in_b")
    )


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both."""
    return _membership(a, b).where("_in_a AND _in_b").drop("_in_a", "_in_b")


def only_in_first(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of the first that the second lacks."""
    return _membership(a, b).where("_in_a AND NOT _in_b").drop("_in_a", "_in_b")

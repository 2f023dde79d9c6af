"""Ranking and neighbour steps.

A window puts each group in one task. Ranking avoids that by limiting groups before the shuffle; the
neighbour steps cut the rows by range, whatever group they belong to, and carry values over the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulframe.operators.joins import lookup
from haulframe.sources.scratch import new_path


def top_rows(df: DataFrame, group: list[str], order: list[Column], n: int, name: str = "seqnum") -> DataFrame:
    """The first ``n`` rows of each group, numbered. ``order`` must be total to be repeatable.

    Spark keeps n rows per group and task before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def top_values(df: DataFrame, group: list[str], value: str, n: int, name: str = "rank") -> DataFrame:
    """Rows whose value is among the ``n`` highest distinct values of their group (dense rank).

    Any number of rows may share a value, so rows are never ranked group by group. Each task first
    keeps the rows with its own n highest values, their distinct values are ranked per group, and all
    rows are then matched with the few ranked values.
    """
    down = F.col(value).desc()
    candidates = (
        df.select(*group, value)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_near", F.dense_rank().over(Window.partitionBy(*group, "_task").orderBy(down)))
        .where(F.col("_near") <= n)
        .select(*group, value)
        .distinct()
    )
    ranked = candidates.withColumn(name, F.dense_rank().over(Window.partitionBy(*group).orderBy(down)))
    return lookup(df, ranked.where(F.col(name) <= n), [*group, value], null_safe=True)


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie_break: str,
    value: str,
    previous: str | None = None,
    following: str | None = None,
) -> DataFrame:
    """Previous and next value within a group ordered by ``order`` and a unique column.

    Null stands for "no such row". Rows are dealt by range of keys, order and tie-break, so a group of
    any size, even with one order value, is cut into parts that are even in rows. The parts are
    written to the shared folder, which fixes them; each part of a group is a window of its own, and
    only the first and last row of every part are looked at across the cuts.
    """
    spark = df.sparkSession
    path = new_path(spark, "ranges")
    df.repartitionByRange(*keys, order, tie_break).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    parts = spark.read.parquet(path)

    row = F.struct(F.struct(*keys).alias("key"), F.col(order), F.col(tie_break), F.col(value).alias("v"))
    ends = parts.groupBy("_part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    along = Window.orderBy("_part")
    ends = ends.select("_part", F.lag("last").over(along).alias("_before"), F.lead("first").over(along).alias("_after"))

    w = Window.partitionBy("_part", *keys).orderBy(F.col(order).asc(), F.col(tie_break).asc())
    made = {}
    if previous:
        made["_is_first"] = F.lag(F.lit(False), 1, True).over(w)
        made[previous] = F.lag(value).over(w)
    if following:
        made["_is_last"] = F.lead(F.lit(False), 1, True).over(w)
        made[following] = F.lead(value).over(w)
    out = parts.withColumns(made).join(ends, "_part")
    own = F.struct(*keys)
    if previous:
        carried = F.when(F.col("_is_first"), F.when(own.eqNullSafe(F.col("_before.key")), F.col("_before.v")))
        out = out.withColumn(previous, F.when(F.col("_is_first"), carried).otherwise(F.col(previous)))
    if following:
        carried = F.when(F.col("_is_last"), F.when(own.eqNullSafe(F.col("_after.key")), F.col("_after.v")))
        out = out.withColumn(following, F.when(F.col("_is_last"), carried).otherwise(F.col(following)))
    return out.drop("_part", "_is_first", "_is_last", "_before", "_after")


def change_pattern(current: str, prior: str) -> Column:
    """How a value compares with the one before it."""
    return (
        F.when(F.col(prior).isNull(), "first transaction")
        .when(F.col(current) > F.col(prior), "increase")
        .when(F.col(current) < F.col(prior), "decrease")
        .otherwise("no change")
    )

"""Aggregation steps. All of them combine on the map side first, and leave little to merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulframe.functions.numeric import rounded
from haulframe.sources.scratch import new_path


def subtotals(base: DataFrame, keys: list[str], amount: str, rows: str, cube: bool = False) -> DataFrame:
    """Sum and average per key combination with subtotals, and the grouping id that tells them apart.

    Only the sum is rounded; the average is that of the total as it is. ``amount`` is a partial sum as a decimal and ``rows`` the number of rows in it. Both are first added
    up per full key, so the copies that a roll-up makes of its input are copies of that small result.
    """
    fine = base.groupBy(*keys).agg(F.sum(amount).alias("_sum"), F.sum(rows).alias("_n"))
    grouped = fine.cube(*keys) if cube else fine.rollup(*keys)
    total = F.sum("_sum")
    return grouped.agg(
        rounded(total).alias("sumamt"),
        (total.cast("double") / F.sum("_n")).alias("avgamt"),
        F.grouping_id().cast("int").alias("level"),
    )


def _unpivot(row: DataFrame, columns: list[str], stats: list[str]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
            for c in columns
        ]
    )
    return row.select(F.inline(entries))


def _basic(column: str, numeric: bool) -> list[Column]:
    col = F.col(column)
    mean = F.avg(col) if numeric else F.lit(None)
    spread = F.stddev_samp(col) if numeric else F.lit(None)
    return [
        F.count(col).alias(f"{column}__count"),
        F.round(mean.cast("double"), 4).alias(f"{column}__mean"),
        F.round(spread.cast("double"), 4).alias(f"{column}__stddev"),
        F.min(col).cast("string").alias(f"{column}__min"),
        F.max(col).cast("string").alias(f"{column}__max"),
    ]


def _is_numeric(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column.

    Numbers and texts are aggregated apart: each column is still read once, and the numeric part stays
    in a hash aggregate, which text minimums would prevent.
    """
    kinds = dict(df.dtypes)
    parts = []
    for numeric in (True, False):
        named = [c for c in columns if _is_numeric(kinds[c]) == numeric]
        if named:
            stats = [s for c in named for s in _basic(c, numeric)]
            parts.append(_unpivot(df.agg(*stats), named, ["count", "mean", "stddev", "min", "max"]))
    return reduce(DataFrame.unionByName, parts)


WHOLE_NUMBERS = ("tinyint", "smallint", "int")


def quantiles(df: DataFrame, columns: list[str], shares: tuple[float, ...]) -> DataFrame:
    """``column_name`` and one text column ``q0``, ``q1``, ... per share: exact quantiles of columns of any ordered type.

    A quantile is the smallest value with at least that share of the values up to it, in the column's
    own type and Spark's order (NaN above infinity); nulls do not count, and a column without values
    has null quantiles. All columns go together, as rows of a column number and a value, which stands in a
    field for its type: one shuffle counts equal values, a second deals the counts by range of column and
    value, and they are written. Running totals over the ranges tell in which one a rank lies; only these
    ranges (at most one per column and share) are gone through value by value.
    """
    spark = df.sparkSession
    kinds = {c: "bigint" if k in WHOLE_NUMBERS else k for c, k in df.dtypes if c in columns}
    fields = {kind: f"v{n}" for n, kind in enumerate(dict.fromkeys(kinds[c] for c in columns))}
    entries = [
        F.struct(
            F.lit(n).alias("c"),
            *[(F.col(c) if kinds[c] == kind else F.lit(None)).cast(kind).alias(name) for kind, name in fields.items()],
        )
        for n, c in enumerate(columns)
    ]
    value = list(fields.values())
    given = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in value])
    counts = df.select(F.inline(F.array(*entries))).where(given).groupBy("c", *value).agg(F.count("*").alias("n"))
    path = new_path(spark, "counts")
    dealt = counts.repartitionByRange("c", *value).withColumn("range", F.spark_partition_id())
    dealt.write.parquet(path)
    counts = spark.read.schema(dealt.schema).parquet(path)

    along = Window.partitionBy("c").orderBy("range")
    totals = counts.groupBy("c", "range").agg(F.sum("n").alias("in_range")).withColumns(
        {"upto": F.sum("in_range").over(along), "all": F.sum("in_range").over(Window.partitionBy("c"))}
    )
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.col("all") * F.lit(q))).alias("rank")) for i, q in enumerate(shares)])
    wanted = totals.select("c", "range", "upto", "in_range", F.inline(ranks)).where("rank <= upto AND rank > upto - in_range")
    wanted = wanted.select("c", "range", "i", (F.col("rank") - F.col("upto") + F.col("in_range")).alias("rank")).collect()
    looked_at = spark.createDataFrame(wanted, "c int, range int, i int, rank bigint")
    near = counts.where(F.col("range").isin(sorted({r["range"] for r in wanted}))).join(looked_at, ["c", "range"])
    within = Window.partitionBy("c", "range", "i").orderBy(*value)
    reached = near.withColumn("upto", F.sum("n").over(within)).where("rank <= upto AND rank > upto - n")
    as_text = F.coalesce(*[F.col(v).cast("string") for v in value])
    stats = [f"q{i}" for i in range(len(shares))]
    found = [
        F.max(F.when((F.col("c") == n) & (F.col("i") == i), as_text)).alias(f"{n}__q{i}") for n in range(len(columns)) for i in range(len(shares))
    ]
    named = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}__{s}").alias(s) for s in stats]) for n, c in enumerate(columns)]
    return reached.agg(*found).select(F.inline(F.array(*named)))


def profile_with_quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """The profile of columns of any type with exact quartiles beside it, as texts like minimum and maximum."""
    points = quantiles(df, columns, (0.25, 0.5, 0.75)).withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"})
    return profile(df, columns).join(points, "column_name")

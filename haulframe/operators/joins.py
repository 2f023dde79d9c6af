"""Join steps shaped so that a key with a large share of the rows does not end up in one task.

Plain inner, left and right joins are left to Spark: adaptive execution picks broadcast or shuffle by
measured size and splits oversized partitions of the preserved side. The steps here cover what it
does not split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulframe.functions.numeric import exact_sum, rounded

# Copies of a lookup side, one per salt, so that one key of the other side spreads over as many tasks.
SALTS = 16


def lookup(
    df: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    null_safe: bool = False,
    salts: int = SALTS,
    grows: bool = False,
) -> DataFrame:
    """Join with a side that has one row per key.

    One plan for all sizes: the side is repeated per salt and every row of ``df`` gets a salt from its own
    values, so a key with a large share of the rows is met by ``salts`` tasks. Spark broadcasts the
    side where it measures it to be small. That is by its files and before it is repeated, a fraction of
    what the driver would hold, so a side that ``grows`` with the input is shuffled whatever its files say.
    """
    renamed = small.select(
        *[F.col(k).alias(f"_k_{k}") for k in on],
        *[c for c in small.columns if c not in on],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_k_salt"),
    )
    renamed = renamed.hint("merge") if grows else renamed
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    pairs = [(F.col(k), F.col(f"_k_{k}")) for k in on]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    joined = salted.join(renamed, [*same, F.col("_salt") == F.col("_k_salt")], how)
    return joined.drop(*[f"_k_{k}" for k in on], "_salt", "_k_salt")


def existing(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows with a match (semi join). The other side is cut to its distinct keys before it is moved."""
    return df.join(other.select(on).distinct(), on, "left_semi")


def missing(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows without a match (anti join); rows with a null key have none."""
    return df.join(other.select(on).distinct(), on, "left_anti")


def _alone(df: DataFrame, other: DataFrame, on: str, salts: int = SALTS) -> DataFrame:
    """Rows without a match, as ``missing`` gives them, with the distinct keys of the other side repeated per salt.

    Adaptive execution does not split a side that meets an aggregate, so a key with a large share of the rows
    is spread over ``salts`` tasks here.
    """
    keys = other.select(on).distinct().withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    return salted.join(keys, [on, "_salt"], "left_anti").drop("_salt")


def reconcile(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Full outer join on one key, which is never null for a one-sided row that has it.

    Spark cannot split an oversized partition of a full join, and of a right join only its right side. An
    inner join, of which it splits both sides, plus the unmatched rows of either side, salted against the distinct
    keys of the other, gives the same rows, wherever a key with a large share of the rows stands.
    """
    matched = left.join(right, on)
    lone_left, lone_right = _alone(left, right, on), _alone(right, left, on)
    return matched.unionByName(lone_left, allowMissingColumns=True).unionByName(lone_right, allowMissingColumns=True)


def peers_per_member(staff: DataFrame, hub: str, member: str) -> DataFrame:
    """For each member: how many rows of other members share the hub, and the first and last of them.

    The pairs themselves grow with the square of the hub, so they are never built: every figure
    comes from per-hub and per-member totals.
    """
    known = staff.where(F.col(hub).isNotNull() & F.col(member).isNotNull())
    rows = known.groupBy(hub, member).agg(F.count("*").alias("_own"))
    hubs = rows.groupBy(hub).agg(
        F.sum("_own").alias("_all"), F.min(member).alias("_low"), F.max(member).alias("_high")
    )
    inner = lookup(rows, hubs, [hub])
    second = inner.groupBy(hub).agg(
        F.min(F.when(F.col(member) != F.col("_low"), F.col(member))).alias("_low2"),
        F.max(F.when(F.col(member) != F.col("_high"), F.col(member))).alias("_high2"),
    )
    return (
        lookup(inner, second, [hub])
        .where(F.col("_all") > F.col("_own"))
        .select(
            F.col(member),
            F.col(hub),
            (F.col("_all") - F.col("_own")).alias("peers"),
            F.when(F.col(member) == F.col("_low"), F.col("_low2")).otherwise(F.col("_low")).alias("first_peer"),
            F.when(F.col(member) == F.col("_high"), F.col("_high2")).otherwise(F.col("_high")).alias("last_peer"),
        )
    )


def with_each_of_top(df: DataFrame, report: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Every row of ``df`` beside each of the ``k`` first rows of ``report``.

    The report is cut to ``k`` rows and numbered; each row of ``df`` is given the slots 1..k and the
    two meet on the slot by an ordinary hash join. The result is ``k`` times ``df``, never more.
    """
    numbered = report.orderBy(*order).limit(k).withColumn("_slot", F.row_number().over(Window.orderBy(*order)))
    slots = df.withColumn("_slot", F.explode(F.sequence(F.lit(1), F.lit(k))))
    return slots.join(F.broadcast(numbered), "_slot").drop("_slot")


def totals_across(
    left: DataFrame, right: DataFrame, on: str, amount: str, left_name: str, right_name: str
) -> DataFrame:
    """Totals of a many-to-many join per key, without building its rows.

    Both sides are aggregated first; each then has one row per key, and the pair count and the sum
    of ``amount`` (a right column) over all pairs follow by multiplication.
    """
    a = left.groupBy(on).agg(F.count("*").alias(left_name))
    b = right.groupBy(on).agg(F.count("*").alias(right_name), exact_sum(amount).alias("_sum"))
    return a.join(b, on).select(
        on,
        left_name,
        right_name,
        (F.col(left_name) * F.col(right_name)).alias("pairs"),
        rounded(F.col("_sum").cast("decimal(24,6)") * F.col(left_name).cast("decimal(13,0)")).alias("pair_amount"),
    )

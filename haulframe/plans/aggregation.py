"""Queries: counts, groups, roll-ups, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.functions.numeric import merged_sums, money_avg, money_sum, partial_sums, rounded, total_of
from haulframe.operators import aggregates
from haulframe.plans import inputs as src
from haulframe.plans.registry import query


@query("agg_count", "SELECT count(*) AS total_cnt FROM lineitem")
def agg_count(spark, sf_dir):
    return src.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("total_cnt"))


@query(
    "agg_distinct_count",
    "SELECT count(*) AS distinct_records FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def agg_distinct_count(spark, sf_dir):
    keys = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return keys.agg(F.count("*").alias("distinct_records"))


@query(
    "agg_dedup_counts",
    "SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS all_columns, "
    "(SELECT count(DISTINCT l_orderkey) FROM lineitem) AS by_key",
)
def agg_dedup_counts(spark, sf_dir):
    # Rows are made distinct per key first, so both counts come from one shuffle of the rows and one of the keys.
    lines = src.table(spark, sf_dir, "lineitem")
    per_key = lines.distinct().groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("all_columns"), F.count("*").alias("by_key"))


@query(
    "agg_group_count",
    f"WITH {src.STAFF_SQL} SELECT origin_hub_city, count(*) AS total_staff FROM staff GROUP BY origin_hub_city",
)
def agg_group_count(spark, sf_dir):
    per_hub = src.crew(spark, sf_dir).groupBy("place_key").agg(F.count("*").alias("total_staff"))
    return src.name_hubs(per_hub, spark, sf_dir)


@query(
    "agg_group_count_distinct",
    "SELECT o_orderpriority, count(DISTINCT o_custkey) AS total_staff FROM orders GROUP BY o_orderpriority",
)
def agg_group_count_distinct(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("total_staff"))


@query(
    "agg_group_sum",
    "SELECT o_orderpriority AS fleet_class, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_weight_kg "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority",
)
def agg_group_sum(spark, sf_dir):
    # Lines are added up per order before they meet the orders.
    per_order = src.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*partial_sums("kg", "l_quantity"))
    orders = src.table(spark, sf_dir, "orders")
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
    grouped = joined.groupBy(F.col("o_orderpriority").alias("fleet_class"))
    return grouped.agg(*merged_sums("kg")).select("fleet_class", rounded(total_of("kg")).alias("sum_weight_kg"))


def hub_costs(spark, sf_dir):
    """Cost per hub and fleet class: summed per member before the join, per hub before the naming."""
    per_member = (
        src.shipments(spark, sf_dir)
        .groupBy("staff_id", "fleet_class")
        .agg(*partial_sums("cost", "shipment_cost"), F.count("*").alias("n"))
    )
    per_hub = (
        per_member.join(src.crew(spark, sf_dir), "staff_id")
        .groupBy("place_key", "fleet_class")
        .agg(*merged_sums("cost"), F.sum("n").alias("n"))
        .select("place_key", "fleet_class", total_of("cost").alias("cost"), "n")
    )
    return src.name_hubs(per_hub, spark, sf_dir)


_HUB_COSTS_SQL = (
    f"WITH {src.STAFF_SQL}, {src.SHIPMENTS_SQL} SELECT origin_hub_city, fleet_class, "
    "CAST(sum(CAST(shipment_cost AS DECIMAL(18,2))) AS DOUBLE) AS sumamt, "
    "CAST(sum(CAST(shipment_cost AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avgamt, "
    "CAST(grouping(origin_hub_city, fleet_class) AS INTEGER) AS level "
    "FROM shipments JOIN staff USING (staff_id) GROUP BY "
)


@query("agg_rollup", f"{_HUB_COSTS_SQL} ROLLUP (origin_hub_city, fleet_class)")
def agg_rollup(spark, sf_dir):
    return aggregates.subtotals(hub_costs(spark, sf_dir), ["origin_hub_city", "fleet_class"], "cost", "n").orderBy(
        "origin_hub_city", "sumamt"
    )


@query("agg_cube", f"{_HUB_COSTS_SQL} CUBE (origin_hub_city, fleet_class)")
def agg_cube(spark, sf_dir):
    return aggregates.subtotals(
        hub_costs(spark, sf_dir), ["origin_hub_city", "fleet_class"], "cost", "n", cube=True
    ).orderBy("origin_hub_city", "sumamt")


def _profile_sql(table: str, column: str, numeric: bool, quartiles: bool = False) -> str:
    mean, spread = (f"round(avg({column}), 4)", f"round(stddev_samp({column}), 4)") if numeric else ("NULL", "NULL")
    points = "".join(
        f"CAST(quantile_disc({column}, {q}) AS VARCHAR) AS p{p}, " for q, p in ((0.25, 25), (0.5, 50), (0.75, 75))
    )
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS count, CAST({mean} AS DOUBLE) AS mean, "
        f"CAST({spread} AS DOUBLE) AS stddev, CAST(min({column}) AS VARCHAR) AS min, {points if quartiles else ''}"
        f"CAST(max({column}) AS VARCHAR) AS max FROM {table}"
    )


#: Every column of the profiled tables, and whether it is a number.
_LINE_COLUMNS = dict.fromkeys(
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split(), True
) | dict.fromkeys("l_returnflag l_linestatus l_shipdate".split(), False)
_ORDER_COLUMNS = dict.fromkeys("o_orderkey o_custkey o_totalprice".split(), True) | dict.fromkeys(
    "o_orderstatus o_orderdate o_orderpriority".split(), False
)


@query("agg_describe", " UNION ALL ".join(_profile_sql("lineitem", c, n) for c, n in _LINE_COLUMNS.items()))
def agg_describe(spark, sf_dir):
    lines = src.table(spark, sf_dir, "lineitem")
    return aggregates.profile(lines, lines.columns)


@query("agg_summary", " UNION ALL ".join(_profile_sql("orders", c, n, True) for c, n in _ORDER_COLUMNS.items()))
def agg_summary(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return aggregates.profile_with_quartiles(orders, orders.columns)


@query(
    "agg_sum_avg",
    "SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sumamt, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avgamt FROM orders GROUP BY o_orderstatus",
)
def agg_sum_avg(spark, sf_dir):
    by_status = src.table(spark, sf_dir, "orders").groupBy("o_orderstatus")
    return by_status.agg(money_sum("o_totalprice").alias("sumamt"), money_avg("o_totalprice").alias("avgamt"))

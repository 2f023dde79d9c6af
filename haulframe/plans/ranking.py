"""Queries: ranks and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.functions.numeric import money_sum
from haulframe.operators import windows
from haulframe.plans import inputs as src
from haulframe.plans.registry import query

_HUB_SQL = (
    f"WITH {src.STAFF_SQL}, {src.SHIPMENTS_SQL}, hub_shipments AS (SELECT origin_hub_city, staff_id, order_id, "
    "shipment_id, shipment_cost FROM shipments JOIN staff USING (staff_id))"
)


def hub_shipments(spark, sf_dir):
    """Shipments with the hub number of the staff member in charge."""
    costs = src.shipments(spark, sf_dir).select("staff_id", "order_id", "shipment_id", "shipment_cost")
    return costs.join(src.crew(spark, sf_dir), "staff_id")


@query(
    "win_topn_row_number",
    f"{_HUB_SQL} SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY origin_hub_city "
    "ORDER BY shipment_cost DESC, shipment_id) AS INTEGER) AS seqnum FROM hub_shipments) WHERE seqnum <= 3",
)
def win_topn_row_number(spark, sf_dir):
    # A member belongs to one hub, so a shipment outside its member's first three is outside the hub's.
    # Cutting per member first keeps a busy member small on its way to the join.
    order = [F.desc("shipment_cost"), F.asc("shipment_id")]
    costs = src.shipments(spark, sf_dir).select("staff_id", "order_id", "shipment_id", "shipment_cost")
    per_member = windows.top_rows(costs, ["staff_id"], order, 3).drop("seqnum")
    top = windows.top_rows(per_member.join(src.crew(spark, sf_dir), "staff_id"), ["place_key"], order, 3)
    return src.name_hubs(top, spark, sf_dir)


@query(
    "win_topn_dense_rank",
    f"{_HUB_SQL} SELECT * FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY origin_hub_city "
    "ORDER BY shipment_cost DESC) AS INTEGER) AS rank FROM hub_shipments) WHERE rank <= 3",
)
def win_topn_dense_rank(spark, sf_dir):
    top = windows.top_values(hub_shipments(spark, sf_dir), ["place_key"], "shipment_cost", 3)
    return src.name_hubs(top, spark, sf_dir)


@query(
    "top_drivers_per_hub",
    f"{_HUB_SQL}, totals AS (SELECT origin_hub_city, staff_id, CAST(sum(CAST(shipment_cost AS DECIMAL(18,2))) AS DOUBLE) "
    "AS total_shipment_cost FROM hub_shipments GROUP BY origin_hub_city, staff_id) SELECT * FROM (SELECT *, "
    "CAST(row_number() OVER (PARTITION BY origin_hub_city ORDER BY total_shipment_cost DESC, staff_id) AS INTEGER) "
    "AS seqnum FROM totals) WHERE seqnum <= 3",
)
def top_drivers_per_hub(spark, sf_dir):
    per_member = (
        src.shipments(spark, sf_dir)
        .groupBy("staff_id")
        .agg(money_sum("shipment_cost").alias("total_shipment_cost"))
    )
    order = [F.desc("total_shipment_cost"), F.asc("staff_id")]
    top = windows.top_rows(per_member.join(src.crew(spark, sf_dir), "staff_id"), ["place_key"], order, 3)
    return src.name_hubs(top, spark, sf_dir)


_TRIPS = ["staff_id", "shipment_id", "shipment_date", "shipment_cost"]


def _trips(spark, sf_dir, **made):
    trips = src.shipments(spark, sf_dir).select(*_TRIPS)
    seen = windows.neighbours(trips, ["staff_id"], "shipment_date", "shipment_id", "shipment_cost", **made)
    return seen.drop("shipment_date")


def _trips_sql(columns: str) -> str:
    return (
        f"WITH {src.SHIPMENTS_SQL} SELECT staff_id, shipment_id, shipment_cost, {columns} FROM shipments "
        "WINDOW w AS (PARTITION BY staff_id ORDER BY shipment_date, shipment_id)"
    )


_NEXT = "lead(shipment_cost) OVER w"
_PRIOR = "lag(shipment_cost) OVER w"


@query("win_lead", _trips_sql(f"coalesce({_NEXT}, -1) AS nexttransamt"))
def win_lead(spark, sf_dir):
    return _trips(spark, sf_dir, following="nexttransamt").na.fill(-1.0, ["nexttransamt"])


@query("win_lag", _trips_sql(f"coalesce({_PRIOR}, -1) AS priortransamt"))
def win_lag(spark, sf_dir):
    return _trips(spark, sf_dir, previous="priortransamt").na.fill(-1.0, ["priortransamt"])


@query(
    "win_change_pattern",
    _trips_sql(
        f"{_NEXT} AS nexttransamt, {_PRIOR} AS priortransamt, CASE WHEN {_PRIOR} IS NULL THEN 'first transaction' "
        f"WHEN shipment_cost > {_PRIOR} THEN 'increase' WHEN shipment_cost < {_PRIOR} THEN 'decrease' "
        "ELSE 'no change' END AS transpattern"
    ),
)
def win_change_pattern(spark, sf_dir):
    trips = _trips(spark, sf_dir, previous="priortransamt", following="nexttransamt")
    return trips.withColumn("transpattern", windows.change_pattern("shipment_cost", "priortransamt"))

"""Queries: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.operators import joins
from haulframe.plans import inputs as src
from haulframe.plans.registry import query

_BOTH = f"WITH {src.STAFF_SQL}, {src.CRITICAL_SQL}"
_CRIT = ["staff_id", "order_id", "shipment_cost"]


def _staff(spark, sf_dir):
    return src.staff(spark, sf_dir).select("staff_id", "origin_hub_city", "role")


def _crit(spark, sf_dir):
    return src.critical(spark, sf_dir).select(*_CRIT)


@query(
    "join_inner",
    f"{_BOTH} SELECT staff_id, origin_hub_city, role, order_id, shipment_cost FROM staff JOIN shipments USING (staff_id)",
)
def join_inner(spark, sf_dir):
    return _staff(spark, sf_dir).join(src.shipments(spark, sf_dir).select(*_CRIT), "staff_id", "inner")


@query(
    "join_left_unmatched",
    f"{_BOTH} SELECT s.staff_id, s.origin_hub_city, s.role FROM staff s LEFT JOIN crit c ON s.staff_id = c.staff_id "
    "WHERE c.staff_id IS NULL",
)
def join_left_unmatched(spark, sf_dir):
    # Idle staff. An outer join with a null test would carry every matched row to the filter.
    return joins.missing(_staff(spark, sf_dir), _crit(spark, sf_dir), "staff_id")


_DRIVERS_SQL = "drivers AS (SELECT staff_id, origin_hub_city, role FROM staff WHERE role = 'driver')"


@query(
    "join_right",
    f"{_BOTH} SELECT c.staff_id, d.origin_hub_city, d.role, c.order_id, c.shipment_cost "
    "FROM staff d RIGHT JOIN shipments c ON d.staff_id = c.staff_id",
)
def join_right(spark, sf_dir):
    return _staff(spark, sf_dir).join(src.shipments(spark, sf_dir).select(*_CRIT), "staff_id", "right")


@query(
    "join_full",
    f"{_BOTH} SELECT coalesce(d.staff_id, c.staff_id) AS staff_id, d.origin_hub_city, d.role, c.order_id, "
    "c.shipment_cost FROM staff d FULL JOIN shipments c ON d.staff_id = c.staff_id",
)
def join_full(spark, sf_dir):
    return joins.reconcile(_staff(spark, sf_dir), src.shipments(spark, sf_dir).select(*_CRIT), "staff_id")


@query(
    "join_semi",
    f"{_BOTH} SELECT staff_id, origin_hub_city, role FROM staff WHERE role = 'driver' "
    "AND EXISTS (SELECT 1 FROM crit WHERE crit.staff_id = staff.staff_id)",
)
def join_semi(spark, sf_dir):
    return joins.existing(_staff(spark, sf_dir).where("role = 'driver'"), _crit(spark, sf_dir), "staff_id")


@query(
    "join_anti",
    f"{_BOTH} SELECT staff_id, origin_hub_city, role FROM staff "
    "WHERE NOT EXISTS (SELECT 1 FROM crit WHERE crit.staff_id = staff.staff_id)",
)
def join_anti(spark, sf_dir):
    return joins.missing(_staff(spark, sf_dir), _crit(spark, sf_dir), "staff_id")


@query(
    "join_self_theta",
    f"WITH {src.STAFF_SQL} SELECT a.staff_id, a.origin_hub_city, count(*) AS peers, min(b.staff_id) AS first_peer, "
    "max(b.staff_id) AS last_peer FROM staff a JOIN staff b ON a.origin_hub_city = b.origin_hub_city "
    "AND a.staff_id <> b.staff_id GROUP BY a.staff_id, a.origin_hub_city",
)
def join_self_theta(spark, sf_dir):
    peers = joins.peers_per_member(src.crew(spark, sf_dir), "place_key", "staff_id")
    return src.name_hubs(peers, spark, sf_dir)


@query(
    "join_cross",
    f"{_BOTH}, report AS (SELECT order_id, shipment_id, shipment_cost FROM shipments WHERE shipment_status = 'DELAYED' "
    "ORDER BY shipment_cost DESC, shipment_id LIMIT 10), "
    f"{_DRIVERS_SQL} SELECT d.staff_id, d.origin_hub_city, r.order_id, r.shipment_cost FROM report r CROSS JOIN drivers d",
)
def join_cross(spark, sf_dir):
    delayed = src.shipments(spark, sf_dir).where("shipment_status = 'DELAYED'")
    report = delayed.select("order_id", "shipment_id", "shipment_cost")
    drivers = _staff(spark, sf_dir).where("role = 'driver'").drop("role")
    order = [F.desc("shipment_cost"), F.asc("shipment_id")]
    return joins.with_each_of_top(drivers, report, order, 10).drop("shipment_id")


@query(
    "join_left_enrich",
    f"WITH {src.STAFF_SQL} SELECT staff_id, origin_hub_city, role, CASE WHEN area <> 'ASIA' THEN CAST(place_key * 1.5 AS DOUBLE) END "
    "AS lat, CASE WHEN area <> 'ASIA' THEN CAST(place_key * 2.5 - 60 AS DOUBLE) END AS long "
    "FROM staff JOIN places ON origin_hub_city = hub",
)
def join_left_enrich(spark, sf_dir):
    s = _staff(spark, sf_dir).alias("s")
    m = src.cities(spark, sf_dir).withColumnRenamed("city_name", "origin_hub_city").alias("m")
    enriched = s.join(m, "origin_hub_city", "left")
    return enriched.select("s.*", F.col("m.latitude").alias("lat"), F.col("m.longitude").alias("long"))


_HUB_SHIPMENTS_SQL = (
    "hub_shipments AS (SELECT origin_hub_city, shipment_id, shipment_cost FROM shipments JOIN staff USING (staff_id))"
)


@query(
    "join_many_to_many",
    f"WITH {src.STAFF_SQL}, {src.SHIPMENTS_SQL}, {_HUB_SHIPMENTS_SQL} SELECT a.origin_hub_city, "
    "count(DISTINCT a.staff_id) AS staff_rows, count(DISTINCT b.shipment_id) AS shipment_rows, count(*) AS pairs, "
    "CAST(sum(CAST(b.shipment_cost AS DECIMAL(18,2))) AS DOUBLE) AS pair_amount "
    "FROM staff a JOIN hub_shipments b ON a.origin_hub_city = b.origin_hub_city GROUP BY a.origin_hub_city",
)
def join_many_to_many(spark, sf_dir):
    crew = src.crew(spark, sf_dir)
    hub_shipments = src.shipments(spark, sf_dir).select("staff_id", "shipment_cost").join(crew, "staff_id")
    totals = joins.totals_across(crew, hub_shipments, "place_key", "shipment_cost", "staff_rows", "shipment_rows")
    return src.name_hubs(totals, spark, sf_dir)

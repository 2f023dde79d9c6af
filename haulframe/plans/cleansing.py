"""Queries: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.operators import joins, quality, sets, shaping
from haulframe.plans import inputs as src
from haulframe.plans.registry import query

_ROSTER = f"WITH {src.ROSTER_SQL} SELECT shipment_id, first_name, last_name, age, role, hub_location, vehicle_type FROM roster"


def _roster(spark, sf_dir):
    return src.roster(spark, sf_dir).select(*src.WIDE)


@query(
    "dq_drop_any",
    f"{_ROSTER} WHERE shipment_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL AND age IS NOT NULL "
    "AND role IS NOT NULL AND hub_location IS NOT NULL AND vehicle_type IS NOT NULL",
)
def dq_drop_any(spark, sf_dir):
    return quality.require(_roster(spark, sf_dir), *src.WIDE)


@query("dq_drop_mandatory", f"{_ROSTER} WHERE shipment_id IS NOT NULL AND role IS NOT NULL")
def dq_drop_mandatory(spark, sf_dir):
    return quality.require(_roster(spark, sf_dir), "shipment_id", "role")


@query("dq_drop_all_subset", f"{_ROSTER} WHERE first_name IS NOT NULL OR last_name IS NOT NULL")
def dq_drop_all_subset(spark, sf_dir):
    return quality.require_one_of(_roster(spark, sf_dir), "first_name", "last_name")


@query("dq_join_ready", f"{_ROSTER} WHERE shipment_id IS NOT NULL")
def dq_join_ready(spark, sf_dir):
    return quality.require(_roster(spark, sf_dir), "shipment_id")


@query(
    "dq_fill",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, coalesce(age, '-1') AS age, coalesce(vehicle_type, 'UNKNOWN') "
    "AS vehicle_type, coalesce(role, 'not provided') AS role FROM roster",
)
def dq_fill(spark, sf_dir):
    rows = src.roster(spark, sf_dir).select("shipment_id", "age", "vehicle_type", "role")
    rows = quality.fill_text(rows, quality.AGE_DEFAULT, "age")
    rows = quality.fill_text(rows, quality.VEHICLE_DEFAULT, "vehicle_type")
    return quality.fill_text(rows, "not provided", "role")


@query(
    "dq_replace",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, CASE WHEN age IN ('ten', '') THEN '-1' ELSE age END AS age, "
    "CASE lower(vehicle_type) WHEN 'truck' THEN 'LMV' WHEN 'bike' THEN 'TwoWheeler' ELSE vehicle_type END "
    "AS vehicle_type FROM roster",
)
def dq_replace(spark, sf_dir):
    rows = src.roster(spark, sf_dir).select("shipment_id", "age", "vehicle_type")
    rows = rows.na.replace(quality.AGE_WORDS, subset=["age"])
    return quality.replace_any_case(rows, "vehicle_type", quality.VEHICLE_WORDS)


@query(
    "dq_common_keys",
    f"WITH {src.SOURCES_SQL}, n AS (SELECT shipment_id, count(*) AS matches FROM src2 GROUP BY shipment_id) "
    "SELECT src1.*, n.matches FROM src1 JOIN n ON src1.shipment_id = n.shipment_id",
)
def dq_common_keys(spark, sf_dir):
    return quality.matches_in(src.source1(spark, sf_dir), src.source2(spark, sf_dir), "shipment_id")


_BOTH_SQL = (
    "both_sources AS (SELECT shipment_id, first_name, last_name, age, role FROM src1 "
    "UNION ALL SELECT shipment_id, first_name, last_name, age, role FROM src2)"
)


@query("dq_dedup_rows", f"WITH {src.SOURCES_SQL}, {_BOTH_SQL} SELECT DISTINCT * FROM both_sources")
def dq_dedup_rows(spark, sf_dir):
    both = src.source1(spark, sf_dir).unionByName(src.source2(spark, sf_dir).select(*src.NARROW))
    return both.distinct()


@query(
    "dq_dedup_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() "
    "OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nth "
    "FROM lineitem) WHERE nth = 1",
)
def dq_dedup_key(spark, sf_dir):
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *rest)
    return quality.dedup_by_key(lines, ["l_orderkey", "l_linenumber"], [F.asc(c) for c in rest])


@query(
    "dq_ref_list",
    f"WITH {src.STAFF_SQL} SELECT staff_id, origin_hub_city FROM staff WHERE origin_hub_city IN "
    "(SELECT hub FROM places WHERE area <> 'ASIA')",
)
def dq_ref_list(spark, sf_dir):
    known = src.cities(spark, sf_dir).select(F.col("city_name").alias("origin_hub_city"))
    staff = src.staff(spark, sf_dir).select("staff_id", "origin_hub_city")
    return joins.existing(staff, known, "origin_hub_city")


@query(
    "dq_ref_list_violations",
    f"WITH {src.STAFF_SQL} SELECT staff_id, origin_hub_city FROM staff WHERE origin_hub_city NOT IN "
    "(SELECT hub FROM places WHERE area <> 'ASIA')",
)
def dq_ref_list_violations(spark, sf_dir):
    known = src.cities(spark, sf_dir).select(F.col("city_name").alias("origin_hub_city"))
    staff = src.staff(spark, sf_dir).select("staff_id", "origin_hub_city")
    return joins.missing(staff, known, "origin_hub_city")


@query(
    "set_union_by_name",
    f"WITH {src.SOURCES_SQL} SELECT *, CAST(NULL AS VARCHAR) AS hub_location, CAST(NULL AS VARCHAR) AS vehicle_type, "
    "'system1' AS datasource FROM src1 UNION ALL SELECT *, 'system2' AS datasource FROM src2",
)
def set_union_by_name(spark, sf_dir):
    return sets.align(
        shaping.tag_source(src.source1(spark, sf_dir), "system1"),
        shaping.tag_source(src.source2(spark, sf_dir), "system2"),
    )


@query(
    "set_intersect",
    f"WITH {src.SOURCES_SQL} SELECT shipment_id FROM src1 INTERSECT SELECT shipment_id FROM src2",
)
def set_intersect(spark, sf_dir):
    return sets.in_both(
        src.source1(spark, sf_dir).select("shipment_id"), src.source2(spark, sf_dir).select("shipment_id")
    )


@query(
    "set_subtract",
    f"WITH {src.SOURCES_SQL} SELECT shipment_id FROM src2 EXCEPT SELECT shipment_id FROM src1",
)
def set_subtract(spark, sf_dir):
    return sets.only_in_first(
        src.source2(spark, sf_dir).select("shipment_id"), src.source1(spark, sf_dir).select("shipment_id")
    )

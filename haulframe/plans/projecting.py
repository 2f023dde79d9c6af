"""Queries: projections, schema, filters, parameters, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.functions import text
from haulframe.operators import ordering, params, shaping
from haulframe.plans import inputs as src
from haulframe.plans.registry import query


@query("proj_select", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def proj_select(spark, sf_dir):
    return src.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query("proj_star", "SELECT * FROM part")
def proj_star(spark, sf_dir):
    return src.table(spark, sf_dir, "part").select("*")


@query("proj_select_expr", "SELECT *, 'system2' AS datasource FROM supplier")
def proj_select_expr(spark, sf_dir):
    return src.table(spark, sf_dir, "supplier").selectExpr("*", "'system2' AS datasource")


@query("proj_literal", "SELECT c_custkey, c_name, 'system1' AS datasource FROM customer")
def proj_literal(spark, sf_dir):
    return shaping.tag_source(src.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "system1")


@query("proj_with_column", "SELECT p_partkey, p_retailprice, p_size, p_size * 2 AS double_size FROM part")
def proj_with_column(spark, sf_dir):
    part = src.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    return part.withColumn("double_size", F.col("p_size") * 2)


@query("proj_rename_one", "SELECT n_nationkey, n_name AS origin_hub_city, n_regionkey FROM nation")
def proj_rename_one(spark, sf_dir):
    return src.table(spark, sf_dir, "nation").withColumnRenamed("n_name", "origin_hub_city")


@query(
    "proj_rename_many",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, first_name AS staff_first_name, last_name AS staff_last_name, "
    "age, role, hub_location AS origin_hub_city, vehicle_type FROM roster",
)
def proj_rename_many(spark, sf_dir):
    return (
        src.roster(spark, sf_dir)
        .drop("balance")
        .withColumnsRenamed(
            {"first_name": "staff_first_name", "last_name": "staff_last_name", "hub_location": "origin_hub_city"}
        )
    )


@query(
    "proj_todf",
    "SELECT c_custkey AS id, c_name AS name, c_nationkey AS loc, c_acctbal AS balance, c_mktsegment AS plan FROM customer",
)
def proj_todf(spark, sf_dir):
    return src.table(spark, sf_dir, "customer").toDF("id", "name", "loc", "balance", "plan")


@query(
    "proj_sanitize_names",
    "SELECT p_partkey AS part_key, p_size AS size_Percent, p_brand AS brand_type FROM part",
)
def proj_sanitize_names(spark, sf_dir):
    messy = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part key"), F.col("p_size").alias("size %"), F.col("p_brand").alias("brand/type")
    )
    return shaping.sanitize_names(messy)


@query("proj_alias", "SELECT s_suppkey AS carrier_id, s_name AS carrier_name FROM supplier")
def proj_alias(spark, sf_dir):
    supplier = src.table(spark, sf_dir, "supplier")
    return supplier.select(F.col("s_suppkey").alias("carrier_id"), F.col("s_name").alias("carrier_name"))


@query(
    "proj_drop",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, concat_ws(' ', first_name, last_name) AS full_name, age, role, "
    "hub_location, vehicle_type FROM roster",
)
def proj_drop(spark, sf_dir):
    named = src.roster(spark, sf_dir).withColumn("full_name", text.full_name("first_name", "last_name"))
    return named.drop("first_name", "last_name", "balance")


_ORDER_COLUMNS = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]


@query(
    "meta_schema",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"count({name}) AS non_null FROM orders"
        for i, (name, kind) in enumerate(_ORDER_COLUMNS, 1)
    ),
)
def meta_schema(spark, sf_dir):
    return shaping.schema_rows(src.table(spark, sf_dir, "orders"))


# Filters


@query("flt_sql_text", f"WITH {src.ROSTER_SQL} SELECT shipment_id, age FROM roster WHERE age <> 'ten'")
def flt_sql_text(spark, sf_dir):
    return src.roster(spark, sf_dir).where("age != 'ten'").select("shipment_id", "age")


@query(
    "flt_in_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def flt_in_list(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query(
    "flt_null",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, role, hub_location FROM roster WHERE age IS NULL AND role IS NOT NULL",
)
def flt_null(spark, sf_dir):
    rows = src.roster(spark, sf_dir).where(F.col("age").isNull() & F.col("role").isNotNull())
    return rows.select("shipment_id", "role", "hub_location")


@query("flt_compare", f"WITH {src.STAFF_SQL} SELECT staff_id, age, role FROM staff WHERE age > 50 AND role = 'driver'")
def flt_compare(spark, sf_dir):
    rows = src.staff(spark, sf_dir).where((F.col("age") > 50) & (F.col("role") == "driver"))
    return rows.select("staff_id", "age", "role")


@query(
    "flt_or",
    f"WITH {src.SHIPMENTS_SQL} SELECT order_id, shipment_status FROM shipments "
    "WHERE shipment_status = 'DELAYED' OR shipment_status = 'RETURNED'",
)
def flt_or(spark, sf_dir):
    status = F.col("shipment_status")
    rows = src.shipments(spark, sf_dir).where((status == "DELAYED") | (status == "RETURNED"))
    return rows.select("order_id", "shipment_status")


@query(
    "flt_rlike",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, role FROM roster WHERE regexp_matches(shipment_id, '[^0-9]')",
)
def flt_rlike(spark, sf_dir):
    return src.roster(spark, sf_dir).where(text.has_non_digit("shipment_id")).select("shipment_id", "role")


@query(
    "flt_not_integer",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, age FROM roster "
    "WHERE age IS NOT NULL AND NOT regexp_matches(age, '^[0-9]+$')",
)
def flt_not_integer(spark, sf_dir):
    rows = src.roster(spark, sf_dir).where(~text.is_whole_number("age") & F.col("age").isNotNull())
    return rows.select("shipment_id", "age")


# The event types offered for choice.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "param_multi_filter",
    "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase')",
)
def param_multi_filter(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return params.choose_many(events, "event_type", "click, purchase", EVENT_TYPES)


@query("param_choice_filter", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def param_choice_filter(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return params.choose_one(events, "event_type", EVENT_TYPES)


# Ordering

_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders"


def _dated_orders(spark, sf_dir):
    return src.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").cast("string").alias("order_date")
    )


@query("sort_desc", f"{_ORDERS} ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark, sf_dir):
    return ordering.sort_total(_dated_orders(spark, sf_dir), [F.desc("o_totalprice")], "o_orderkey")


@query("sort_asc", f"{_ORDERS} ORDER BY order_date, o_orderkey")
def sort_asc(spark, sf_dir):
    return ordering.sort_total(_dated_orders(spark, sf_dir), [F.asc("order_date")], "o_orderkey")


@query("sort_multi", f"{_ORDERS} ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def sort_multi(spark, sf_dir):
    return ordering.sort_total(_dated_orders(spark, sf_dir), [F.asc("o_custkey"), F.desc("o_totalprice")], "o_orderkey")


@query(
    "topk_filtered",
    f"WITH {src.SHIPMENTS_SQL} SELECT order_id, shipment_id, shipment_cost FROM shipments "
    "WHERE shipment_status = 'DELAYED' ORDER BY shipment_cost DESC, shipment_id LIMIT 10",
)
def topk_filtered(spark, sf_dir):
    delayed = src.shipments(spark, sf_dir).where("shipment_status = 'DELAYED'")
    delayed = delayed.select("order_id", "shipment_id", "shipment_cost")
    return ordering.top_k(delayed, [F.desc("shipment_cost")], "shipment_id", 10)


@query(
    "sample_fraction",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < '1999999a'",
)
def sample_fraction(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordering.sample_by_key(orders, "o_orderkey", 0.1)

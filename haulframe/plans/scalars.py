"""Queries: column functions and staff rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.functions import dates, flags, numeric, people, text
from haulframe.operators import shaping
from haulframe.plans import inputs as src
from haulframe.plans.registry import query

TITLE_SQL = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query(
    "std_case",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, lower(role) AS role, {TITLE_SQL.format('hub_location')} AS hub_location, "
    "upper(vehicle_type) AS vehicle_type FROM roster",
)
def std_case(spark, sf_dir):
    rows = src.roster(spark, sf_dir).select("shipment_id", "role", "hub_location", "vehicle_type")
    return text.standard_case(rows, lower=("role",), upper=("vehicle_type",), title=("hub_location",))


@query(
    "merge_columns",
    f"WITH {src.ROSTER_SQL} SELECT shipment_id, concat_ws(' ', first_name, last_name) AS full_name, "
    "hub_location || '-' || role AS route_segment, vehicle_type || '_' || shipment_id AS vehicle_identifier FROM roster",
)
def merge_columns(spark, sf_dir):
    return src.roster(spark, sf_dir).select(
        "shipment_id",
        text.full_name("first_name", "last_name").alias("full_name"),
        text.route_segment("hub_location", "role").alias("route_segment"),
        text.composite_key("vehicle_type", "shipment_id").alias("vehicle_identifier"),
    )


@query(
    "split_code",
    f"WITH {src.SHIPMENTS_SQL} SELECT order_id, substring(order_id, 1, 3) AS order_prefix, "
    "substring(order_id, 4) AS order_sequence FROM shipments",
)
def split_code(spark, sf_dir):
    return src.shipments(spark, sf_dir).select(
        "order_id",
        text.code_prefix("order_id").alias("order_prefix"),
        text.code_sequence("order_id").alias("order_sequence"),
    )


@query(
    "split_name",
    "SELECT p_partkey, string_split(p_name, ' ')[1] AS first_part, string_split(p_name, ' ')[-1] AS last_part FROM part",
)
def split_name(spark, sf_dir):
    return src.table(spark, sf_dir, "part").select(
        "p_partkey", text.first_word("p_name").alias("first_part"), text.last_word("p_name").alias("last_part")
    )


@query("format_currency", "SELECT o_orderkey, '₹' || format('{:,.2f}', o_totalprice) AS cost_text FROM orders")
def format_currency(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.format_currency("o_totalprice").alias("cost_text"))


@query("parse_currency", "SELECT o_orderkey, o_totalprice AS cost FROM orders")
def parse_currency(spark, sf_dir):
    formatted = format_currency(spark, sf_dir)
    return formatted.select("o_orderkey", text.parse_currency("cost_text").alias("cost"))


@query(
    "num_round",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * "
    "CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(4,2)), 2) AS DOUBLE) AS net_price FROM lineitem",
)
def num_round(spark, sf_dir):
    kept = (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")).cast("decimal(4,2)")
    net = F.col("l_extendedprice").cast("decimal(12,2)") * kept
    return src.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numeric.round_money(net).alias("net_price")
    )


@query(
    "num_try_divide",
    f"WITH {src.WEIGHTS_SQL} SELECT o_orderkey, o_totalprice, shipment_weight_kg, "
    "CASE WHEN shipment_weight_kg = 0 THEN NULL ELSE o_totalprice / shipment_weight_kg END AS cost_per_kg "
    "FROM orders LEFT JOIN weights ON o_orderkey = l_orderkey",
)
def num_try_divide(spark, sf_dir):
    orders, weights = src.table(spark, sf_dir, "orders"), src.weights(spark, sf_dir)
    weighed = orders.join(weights, orders.o_orderkey == weights.l_orderkey, "left")
    return weighed.select(
        "o_orderkey",
        "o_totalprice",
        "shipment_weight_kg",
        numeric.cost_per_kg("o_totalprice", "shipment_weight_kg").alias("cost_per_kg"),
    )


@query(
    "num_tax",
    "SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.18 AS DECIMAL(4,2)), 2) AS DOUBLE) "
    "AS tax_amount FROM orders",
)
def num_tax(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", numeric.tax_amount("o_totalprice").alias("tax_amount"))


@query(
    "cast_types",
    f"WITH {src.ROSTER_SQL} SELECT TRY_CAST(shipment_id AS BIGINT) AS shipment_id, TRY_CAST(age AS INTEGER) AS age, "
    "CAST(CAST(balance AS VARCHAR) AS DOUBLE) AS balance, CAST('False' AS BOOLEAN) AS is_expedited FROM roster",
)
def cast_types(spark, sf_dir):
    return src.roster(spark, sf_dir).select(
        F.col("shipment_id").try_cast("bigint").alias("shipment_id"),
        F.col("age").try_cast("int").alias("age"),
        F.col("balance").cast("string").try_cast("double").alias("balance"),
        F.lit("False").cast("boolean").alias("is_expedited"),
    )


@query(
    "date_reformat",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS shipment_date FROM orders",
)
def date_reformat(spark, sf_dir):
    # The landing text has one layout per priority, and one that no layout fits.
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate")
    landed = (
        F.when(priority == "1-URGENT", F.date_format(day, "dd-MM-yy"))
        .when(priority == "2-HIGH", F.date_format(day, "dd-MM-yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy/MM/dd"))
        .when(priority == "5-LOW", F.date_format(day, "yyyy-MM-dd"))
        .otherwise("not given")
    )
    rows = src.table(spark, sf_dir, "orders").select("o_orderkey", landed.alias("day_text"))
    parsed = dates.parse_date("day_text", latest="2025-12-31")
    return rows.select("o_orderkey", dates.iso_text(parsed).alias("shipment_date"))


@query(
    "date_parts",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ship_year, CAST(month(o_orderdate) AS INTEGER) "
    "AS ship_month, CAST(day(o_orderdate) AS INTEGER) AS shipment_day FROM orders",
)
def date_parts(spark, sf_dir):
    return src.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("ship_year"),
        F.month("o_orderdate").alias("ship_month"),
        F.day("o_orderdate").alias("shipment_day"),
    )


@query("date_weekend_flag", "SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders")
def date_weekend_flag(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", dates.is_weekend("o_orderdate").alias("is_weekend"))


@query(
    "date_days_since",
    "SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) "
    "AS days_since_shipment FROM orders",
)
def date_days_since(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", dates.days_since("o_orderdate", "2002-01-01").alias("days_since_shipment"))


@query(
    "flag_status",
    f"WITH {src.SHIPMENTS_SQL} SELECT order_id, shipment_status, shipment_status IN ('IN_TRANSIT', 'DELIVERED') "
    "AS is_expedited FROM shipments",
)
def flag_status(spark, sf_dir):
    rows = src.shipments(spark, sf_dir)
    return rows.select("order_id", "shipment_status", flags.is_expedited("shipment_status").alias("is_expedited"))


@query("flag_high_value", "SELECT o_orderkey, o_totalprice > 50000 AS is_high_value FROM orders")
def flag_high_value(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", flags.is_high_value("o_totalprice").alias("is_high_value"))


@query(
    "audit_columns",
    "SELECT s_suppkey, 'logistics' AS domain, true AS has_timestamp, false AS is_expedited FROM supplier",
)
def audit_columns(spark, sf_dir):
    rows = shaping.add_audit(src.table(spark, sf_dir, "supplier"))
    return rows.select(
        "s_suppkey", "domain", F.col("ingestion_timestamp").isNotNull().alias("has_timestamp"), "is_expedited"
    )


_BONUS_SQL = (
    f"WITH {src.STAFF_SQL} SELECT staff_id, CAST(CASE WHEN role = 'driver' AND age > 50 THEN 3000.0 "
    "WHEN role = 'driver' AND age < 30 THEN 500.0 ELSE 0.0 END AS DOUBLE) AS projected_bonus FROM staff"
)


@query("udf_bonus", _BONUS_SQL)
def udf_bonus(spark, sf_dir):
    return src.staff(spark, sf_dir).select("staff_id", people.bonus().alias("projected_bonus"))


@query("udf_bonus_pandas", _BONUS_SQL)
def udf_bonus_pandas(spark, sf_dir):
    return src.staff(spark, sf_dir).select("staff_id", people.bonus_arrow("role", "age").alias("projected_bonus"))


_MASK_SQL = (
    f"WITH {src.STAFF_SQL} SELECT staff_id, CASE WHEN length(staff_name) < 3 THEN staff_name "
    "ELSE left(staff_name, 2) || '****' || right(staff_name, 1) END AS masked_name FROM staff"
)


@query("udf_mask", _MASK_SQL)
def udf_mask(spark, sf_dir):
    return src.staff(spark, sf_dir).select("staff_id", people.mask_name("staff_name").alias("masked_name"))


@query("udf_mask_pandas", _MASK_SQL)
def udf_mask_pandas(spark, sf_dir):
    people.register(spark)
    return src.staff(spark, sf_dir).selectExpr("staff_id", "mask_name(staff_name) AS masked_name")

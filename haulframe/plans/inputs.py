"""Freight tables read off the given star schema, each once in Spark and once as SQL.

staff rows come from ``customer`` with its nation and region, shipments from ``orders`` with the
weight of their ``lineitem`` rows. The raw forms carry the dirt that the cleansing steps deal with;
every rule uses values of the row, and no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulframe.functions.numeric import money_sum


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files are now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hub names by nation key: the nation with its region, in lower case."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("place_key"),
        F.lower(F.concat_ws(" ", "r_name", "n_name")).alias("hub"),
        F.col("r_name").alias("area"),
    )


PLACES_SQL = """
places AS (
  SELECT n_nationkey AS place_key, lower(r_name || ' ' || n_name) AS hub, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def crew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff with the number of their hub. Numbers are cheaper to move and group by than names."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("staff_id"), F.col("c_nationkey").alias("place_key")
    )


def name_hubs(df: DataFrame, spark: SparkSession, sf_dir: str, name: str = "origin_hub_city") -> DataFrame:
    """Replace the hub number by its name, as late as possible."""
    named = places(spark, sf_dir).select("place_key", F.col("hub").alias(name))
    return df.join(named, "place_key").drop("place_key")


def age_of(balance: str = "c_acctbal"):
    return (F.floor(F.abs(F.col(balance)) / 175) + 10).cast("int")


AGE_SQL = "CAST(floor(abs(c_acctbal) / 175) AS INTEGER) + 10"


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean staff, one row per customer."""
    customer = table(spark, sf_dir, "customer")
    hubs = places(spark, sf_dir)
    return customer.join(hubs, customer.c_nationkey == hubs.place_key).select(
        F.col("c_custkey").alias("staff_id"),
        F.col("c_name").alias("staff_name"),
        age_of().alias("age"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "driver").otherwise(F.lower("c_mktsegment")).alias("role"),
        F.col("hub").alias("origin_hub_city"),
        F.col("c_mktsegment").alias("vehicle_type"),
    )


STAFF_SQL = f"""{PLACES_SQL},
staff AS (
  SELECT c_custkey AS staff_id, c_name AS staff_name, {AGE_SQL} AS age,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'driver' ELSE lower(c_mktsegment) END AS role,
         hub AS origin_hub_city, c_mktsegment AS vehicle_type
  FROM customer JOIN places ON c_nationkey = place_key
)"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw staff, all text, with missing and invalid values; ``balance`` says who is in which source."""
    customer = table(spark, sf_dir, "customer")
    hubs = places(spark, sf_dir)
    place, balance, segment = F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    key = F.col("c_custkey").cast("string")
    name = F.split("c_name", "#")
    vehicle = (
        F.when(segment == "AUTOMOBILE", "Truck")
        .when(segment == "BUILDING", "truck")
        .when(segment == "FURNITURE", "Bike")
        .when(segment == "HOUSEHOLD", "BIKE")
    )
    return customer.join(hubs, place == hubs.place_key).select(
        F.when((place == 21) & (balance < 3000), None)
        .when(place == 20, F.concat(F.lit("X"), key))
        .otherwise(key)
        .alias("shipment_id"),
        F.when(balance >= 2500, name[0]).alias("first_name"),
        F.when(balance >= 500, name[1]).alias("last_name"),
        F.when(place == 10, "ten")
        .when(place == 11, "")
        .when(place == 12, None)
        .otherwise(age_of().cast("string"))
        .alias("age"),
        F.when(place == 13, None).when(segment == "MACHINERY", "Driver").otherwise(segment).alias("role"),
        F.when(place != 14, F.col("hub")).alias("hub_location"),
        vehicle.alias("vehicle_type"),
        balance.alias("balance"),
    )


ROSTER_SQL = f"""{PLACES_SQL},
roster AS (
  SELECT CASE WHEN c_nationkey = 21 AND c_acctbal < 3000 THEN NULL
              WHEN c_nationkey = 20 THEN 'X' || CAST(c_custkey AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) END AS shipment_id,
         CASE WHEN c_acctbal >= 2500 THEN split_part(c_name, '#', 1) END AS first_name,
         CASE WHEN c_acctbal >= 500 THEN split_part(c_name, '#', 2) END AS last_name,
         CASE WHEN c_nationkey = 10 THEN 'ten' WHEN c_nationkey = 11 THEN '' WHEN c_nationkey = 12 THEN NULL
              ELSE CAST({AGE_SQL} AS VARCHAR) END AS age,
         CASE WHEN c_nationkey = 13 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'Driver'
              ELSE c_mktsegment END AS role,
         CASE WHEN c_nationkey <> 14 THEN hub END AS hub_location,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Truck' WHEN 'BUILDING' THEN 'truck'
              WHEN 'FURNITURE' THEN 'Bike' WHEN 'HOUSEHOLD' THEN 'BIKE' END AS vehicle_type,
         c_acctbal AS balance
  FROM customer JOIN places ON c_nationkey = place_key
)"""

NARROW = ["shipment_id", "first_name", "last_name", "age", "role"]
WIDE = [*NARROW, "hub_location", "vehicle_type"]


def source1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First source: five columns, balances under 6000."""
    return roster(spark, sf_dir).where("balance < 6000").select(*NARROW)


def source2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: seven columns, balances over 2000. Staff in between are in both."""
    return roster(spark, sf_dir).where("balance > 2000").select(*WIDE)


SOURCES_SQL = f"""{ROSTER_SQL},
src1 AS (SELECT shipment_id, first_name, last_name, age, role FROM roster WHERE balance < 6000),
src2 AS (SELECT shipment_id, first_name, last_name, age, role, hub_location, vehicle_type
         FROM roster WHERE balance > 2000)"""


def status_of():
    return (
        F.when(F.col("o_orderstatus") == "F", "DELAYED")
        .when(F.col("o_orderstatus") == "O", "IN_TRANSIT")
        .when(F.col("o_totalprice") > 250000, "RETURNED")
        .otherwise("DELIVERED")
    )


STATUS_SQL = """CASE WHEN o_orderstatus = 'F' THEN 'DELAYED' WHEN o_orderstatus = 'O' THEN 'IN_TRANSIT'
              WHEN o_totalprice > 250000 THEN 'RETURNED' ELSE 'DELIVERED' END"""


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean shipments, one row per order."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ORD"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.col("o_orderkey").alias("shipment_id"),
        F.col("o_custkey").alias("staff_id"),
        status_of().alias("shipment_status"),
        F.col("o_totalprice").alias("shipment_cost"),
        F.col("o_orderdate").cast("date").alias("shipment_date"),
        F.col("o_orderpriority").alias("fleet_class"),
    )


SHIPMENTS_SQL = f"""
shipments AS (
  SELECT 'ORD' || CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey AS shipment_id, o_custkey AS staff_id,
         {STATUS_SQL} AS shipment_status, o_totalprice AS shipment_cost,
         CAST(o_orderdate AS DATE) AS shipment_date, o_orderpriority AS fleet_class
  FROM orders
)"""


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilograms per order; lines that came back weigh nothing, so the weight may be zero."""
    kept = F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0.0)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        money_sum(kept).alias("shipment_weight_kg")
    )


WEIGHTS_SQL = """
weights AS (
  SELECT l_orderkey,
         CAST(sum(CAST(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE)
           AS shipment_weight_kg
  FROM lineitem GROUP BY l_orderkey
)"""


def critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delayed shipments of over 400,000."""
    return shipments(spark, sf_dir).where("shipment_status = 'DELAYED' AND shipment_cost > 400000")


CRITICAL_SQL = f"""{SHIPMENTS_SQL},
crit AS (SELECT * FROM shipments WHERE shipment_status = 'DELAYED' AND shipment_cost > 400000)"""


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master city list; Asia is not on it."""
    return (
        places(spark, sf_dir)
        .where("area <> 'ASIA'")
        .select(
            F.col("hub").alias("city_name"),
            (F.col("place_key") * 1.5).cast("double").alias("latitude"),
            (F.col("place_key") * 2.5 - 60).cast("double").alias("longitude"),
        )
    )


CITIES_SQL = f"""{PLACES_SQL},
cities AS (SELECT hub AS city_name, CAST(place_key * 1.5 AS DOUBLE) AS latitude,
                  CAST(place_key * 2.5 - 60 AS DOUBLE) AS longitude
           FROM places WHERE area <> 'ASIA')"""

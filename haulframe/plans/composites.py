"""Queries: whole flows made of the steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.functions import dates, flags, numeric, people, text
from haulframe.operators import aggregates, joins, ordering, quality, sets, shaping
from haulframe.plans import inputs as src
from haulframe.plans.registry import query
from haulframe.plans.scalars import TITLE_SQL
from haulframe.sources import tables

AS_OF = "2002-01-01"


# Profile


def source_profile(tagged: DataFrame, columns: list[str], key: str, expected: dict[str, int]) -> DataFrame:
    """One row of findings per source of tagged, staged rows. Nothing is changed.

    Row and key counts, what de-duplication by row and by key would remove, invalid values, field widths of the
    raw lines (``line``) against the expected number, and the spread of field lengths.
    """
    width = quality.field_count("line", most=max(expected.values()))
    wanted = F.coalesce(*[F.when(F.col("source") == s, F.lit(n)) for s, n in expected.items()])
    total, rows, keys = F.count("*"), F.count_distinct(F.struct(*columns)), F.count_distinct(key)
    return tagged.groupBy("source").agg(
        total.alias("total"),
        rows.alias("distinct_records"),
        keys.alias("distinct_keys"),
        (total - rows).alias("repeated_rows"),
        (F.count(key) - keys).alias("repeated_keys"),
        F.count_if(text.has_non_digit(key)).alias("non_numeric_keys"),
        F.count_if(~text.is_whole_number("age")).alias("non_integer_ages"),
        F.count_if(F.col("role").isNull()).alias("missing_roles"),
        F.count_if(width < wanted).alias("too_short"),
        F.count_if(width > wanted).alias("too_long"),
        *[F.max(F.length(c)).alias(f"widest_{c}") for c in ("first_name", "last_name")],
    )


def _profile_sql(name: str, source: str, other: str, columns: str, short: str) -> str:
    return (
        f"SELECT '{name}' AS source, count(*) AS total, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source})) AS distinct_records, "
        "count(DISTINCT shipment_id) AS distinct_keys, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source})) AS repeated_rows, "
        "count(shipment_id) - count(DISTINCT shipment_id) AS repeated_keys, "
        "count(*) FILTER (regexp_matches(shipment_id, '[^0-9]')) AS non_numeric_keys, "
        "count(*) FILTER (NOT regexp_matches(age, '^[0-9]+$')) AS non_integer_ages, "
        f"count(*) FILTER (role IS NULL) AS missing_roles, {short} AS too_short, 0 AS too_long, "
        "CAST(max(length(first_name)) AS INTEGER) AS widest_first_name, "
        "CAST(max(length(last_name)) AS INTEGER) AS widest_last_name, "
        f"count(*) FILTER (shipment_id IN (SELECT shipment_id FROM {other} WHERE shipment_id IS NOT NULL)) "
        f"AS rows_in_other FROM {source}"
    )


def tagged_sources(spark, sf_dir) -> DataFrame:
    """Both staged sources with the raw line they come from; lines of staff without a role lack their last fields."""
    parts = []
    for source, name, columns in ((src.source1, "system1", src.NARROW), (src.source2, "system2", src.WIDE)):
        rows = source(spark, sf_dir)
        head = [c for c in columns[: columns.index("role")]]
        line = F.when(F.col("role").isNull(), F.to_csv(F.struct(*head))).otherwise(F.to_csv(F.struct(*columns)))
        parts.append(shaping.tag_source(rows.withColumn("line", line), name, "source"))
    return sets.align(*parts)


@query(
    "pipe_profile",
    f"WITH {src.SOURCES_SQL} "
    + " UNION ALL ".join(
        _profile_sql(name, own, other, ", ".join(columns), "count(*) FILTER (role IS NULL)")
        for name, own, other, columns in (("system1", "src1", "src2", src.NARROW), ("system2", "src2", "src1", src.WIDE))
    ),
)
def pipe_profile(spark, sf_dir):
    tagged = tagged_sources(spark, sf_dir)
    expected = {"system1": len(src.NARROW), "system2": len(src.WIDE)}
    profiles = source_profile(tagged, src.WIDE, "shipment_id", expected)
    # Rows per key in each source, side by side: a key counts where it is in both.
    keys = tagged.where(F.col("shipment_id").isNotNull())
    in_source = [F.count_if(F.col("source") == s).alias(s) for s in expected]
    common = keys.groupBy("shipment_id").agg(*in_source).where("system1 > 0 AND system2 > 0")
    shared = common.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in expected]).select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).alias("rows_in_other")) for s in expected]))
    )
    return profiles.join(shared, "source")


@query(
    "pipe_profile_columns",
    f"WITH {src.SOURCES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS source, '{c}' AS column_name, count({c}) AS count, CAST(NULL AS DOUBLE) AS mean, "
        f"CAST(NULL AS DOUBLE) AS stddev, min({c}) AS min, max({c}) AS max FROM {own}"
        for name, own, columns in (("system1", "src1", src.NARROW), ("system2", "src2", src.WIDE))
        for c in columns
    ),
)
def pipe_profile_columns(spark, sf_dir):
    parts = []
    for source, name in ((src.source1, "system1"), (src.source2, "system2")):
        rows = source(spark, sf_dir)
        parts.append(aggregates.profile(rows, rows.columns).withColumn("source", F.lit(name)))
    return parts[0].unionByName(parts[1])


# Silver staff


def silver_staff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Align, cleanse, scrub, standardise and de-duplicate the two staged staff sources."""
    both = sets.align(shaping.tag_source(first, "system1"), shaping.tag_source(second, "system2"))
    kept = quality.require_one_of(quality.require(both, "shipment_id", "role"), "first_name", "last_name")
    scrubbed = quality.scrub_staff(kept)
    cased = text.standard_case(
        scrubbed,
        lower=("shipment_id", "first_name", "last_name", "role", "datasource"),
        upper=("vehicle_type",),
        title=("hub_location",),
    )
    named = cased.withColumn("age", F.col("age").try_cast("int")).withColumnsRenamed(
        {"first_name": "staff_first_name", "last_name": "staff_last_name", "hub_location": "origin_hub_city"}
    )
    rest = ["staff_first_name", "staff_last_name", "age", "role", "origin_hub_city", "vehicle_type"]
    order = [F.desc("datasource"), *[F.asc(c) for c in rest]]
    return quality.dedup_by_key(named, ["shipment_id"], order)


_TIDY_SQL = f"""{src.SOURCES_SQL},
aligned AS (
  SELECT *, CAST(NULL AS VARCHAR) AS hub_location, CAST(NULL AS VARCHAR) AS vehicle_type, 'system1' AS datasource FROM src1
  UNION ALL SELECT *, 'system2' AS datasource FROM src2
),
tidy AS (
  SELECT lower(shipment_id) AS shipment_id, lower(first_name) AS staff_first_name, lower(last_name) AS staff_last_name,
         CAST(CASE WHEN age IS NULL OR age IN ('ten', '') THEN '-1' ELSE age END AS INTEGER) AS age, lower(role) AS role,
         {TITLE_SQL.format("hub_location")} AS origin_hub_city,
         upper(CASE lower(coalesce(vehicle_type, 'UNKNOWN')) WHEN 'truck' THEN 'LMV' WHEN 'bike' THEN 'TwoWheeler'
               ELSE coalesce(vehicle_type, 'UNKNOWN') END) AS vehicle_type, datasource
  FROM aligned WHERE shipment_id IS NOT NULL AND role IS NOT NULL AND (first_name IS NOT NULL OR last_name IS NOT NULL)
)"""


@query(
    "pipe_silver_staff",
    f"""WITH {_TIDY_SQL}
SELECT shipment_id, staff_first_name, staff_last_name, age, role, origin_hub_city, vehicle_type, datasource,
       concat_ws(' ', staff_first_name, staff_last_name) AS full_name,
       CAST(CASE WHEN role = 'driver' AND age > 50 THEN 3000 WHEN role = 'driver' AND age < 30 THEN 500 ELSE 0 END AS DOUBLE)
         AS projected_bonus,
       CASE WHEN length(staff_last_name) < 3 THEN staff_last_name
            ELSE left(staff_last_name, 2) || '****' || right(staff_last_name, 1) END AS masked_name,
       true AS has_load_dt
FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY datasource DESC) AS nth FROM tidy) WHERE nth = 1""",
)
def pipe_silver_staff(spark, sf_dir):
    silver = silver_staff(src.source1(spark, sf_dir), src.source2(spark, sf_dir))
    enriched = silver.withColumns(
        {
            "load_dt": F.current_timestamp(),
            "full_name": text.full_name("staff_first_name", "staff_last_name"),
            "projected_bonus": people.bonus(),
            "masked_name": people.mask_name("staff_last_name"),
        }
    )
    return enriched.withColumn("has_load_dt", F.col("load_dt").isNotNull()).drop("load_dt")


# Silver shipments


def raw_shipments(spark, sf_dir) -> DataFrame:
    """Shipments as they land: text dates and weights, upper-case status."""
    ships, weights = src.shipments(spark, sf_dir), src.weights(spark, sf_dir)
    weighed = ships.join(weights, ships.shipment_id == weights.l_orderkey, "left").drop("l_orderkey")
    placed = weighed.join(src.crew(spark, sf_dir), "staff_id")
    return src.name_hubs(placed, spark, sf_dir, "source_city").select(
        "shipment_id",
        "order_id",
        "source_city",
        F.upper("fleet_class").alias("destination_city"),
        "shipment_status",
        "shipment_cost",
        F.col("shipment_weight_kg").cast("string").alias("shipment_weight_kg"),
        F.date_format("shipment_date", "dd-MM-yy").alias("shipment_date"),
        F.col("fleet_class").alias("vehicle_type"),
    )


def silver_shipments(raw: DataFrame, as_of: str | None = None, latest: str | None = None) -> DataFrame:
    """Standardise, enrich and derive: text to types, route and keys, date parts, flags, ratios, tax."""
    cased = text.standard_case(
        raw, lower=("order_id", "source_city", "destination_city", "shipment_status", "vehicle_type")
    )
    typed = shaping.add_audit(cased).withColumns(
        {
            "shipment_weight_kg": F.col("shipment_weight_kg").try_cast("double"),
            "shipment_cost": numeric.round_money(numeric.money("shipment_cost")),
            "shipment_date": dates.parse_date("shipment_date", latest=latest),
        }
    )
    return typed.select(
        "shipment_id",
        "order_id",
        text.code_prefix("order_id").alias("order_prefix"),
        text.code_sequence("order_id").alias("order_sequence"),
        text.route_segment("source_city", "destination_city").alias("route_segment"),
        text.composite_key("vehicle_type", "shipment_id").alias("vehicle_identifier"),
        "shipment_status",
        "shipment_cost",
        "shipment_weight_kg",
        dates.iso_text("shipment_date").alias("shipment_date"),
        F.year("shipment_date").alias("ship_year"),
        F.month("shipment_date").alias("ship_month"),
        F.day("shipment_date").alias("shipment_day"),
        dates.is_weekend("shipment_date").alias("is_weekend"),
        flags.is_expedited("shipment_status").alias("is_expedited"),
        flags.is_high_value("shipment_cost").alias("is_high_value"),
        numeric.cost_per_kg("shipment_cost", "shipment_weight_kg").alias("cost_per_kg"),
        dates.days_since("shipment_date", as_of).alias("days_since_shipment"),
        numeric.tax_amount("shipment_cost").alias("tax_amount"),
        "domain",
        "ingestion_timestamp",
    )


@query(
    "pipe_silver_shipments",
    f"""WITH {src.STAFF_SQL}, {src.SHIPMENTS_SQL}, {src.WEIGHTS_SQL}
SELECT shipment_id, lower(order_id) AS order_id, 'ord' AS order_prefix, CAST(shipment_id AS VARCHAR) AS order_sequence,
       origin_hub_city || '-' || lower(fleet_class) AS route_segment,
       lower(fleet_class) || '_' || CAST(shipment_id AS VARCHAR) AS vehicle_identifier,
       lower(shipment_status) AS shipment_status, shipment_cost, shipment_weight_kg,
       CAST(shipment_date AS VARCHAR) AS shipment_date, CAST(year(shipment_date) AS INTEGER) AS ship_year,
       CAST(month(shipment_date) AS INTEGER) AS ship_month, CAST(day(shipment_date) AS INTEGER) AS shipment_day,
       dayofweek(shipment_date) IN (0, 6) AS is_weekend, shipment_status IN ('IN_TRANSIT', 'DELIVERED') AS is_expedited,
       shipment_cost > 50000 AS is_high_value,
       CASE WHEN shipment_weight_kg = 0 THEN NULL ELSE shipment_cost / shipment_weight_kg END AS cost_per_kg,
       CAST(date_diff('day', shipment_date, DATE '{AS_OF}') AS INTEGER) AS days_since_shipment,
       CAST(round(CAST(shipment_cost AS DECIMAL(18,2)) * CAST(0.18 AS DECIMAL(4,2)), 2) AS DOUBLE) AS tax_amount,
       'logistics' AS domain
FROM shipments JOIN staff USING (staff_id) LEFT JOIN weights ON shipment_id = l_orderkey""",
)
def pipe_silver_shipments(spark, sf_dir):
    silver = silver_shipments(raw_shipments(spark, sf_dir), AS_OF, latest=AS_OF)
    return silver.drop("ingestion_timestamp")


# All records in one layout


def aligned_records(staff: DataFrame, ships: DataFrame) -> DataFrame:
    """Staff and shipments as one set of records in the common column order, one per shipment id.

    One record per id leaves no equal records either, so those need no step of their own.
    """
    columns = [
        "shipment_id",
        "staff_first_name",
        "staff_last_name",
        "role",
        "origin_hub_city",
        "shipment_cost",
        "ingestion_timestamp",
    ]
    both = sets.align(staff, ships.withColumn("shipment_id", F.col("shipment_id").cast("string"))).select(*columns)
    order = [F.col("shipment_cost").desc_nulls_last(), *[F.asc(c) for c in columns if c not in ("shipment_id", "shipment_cost")]]
    return quality.dedup_by_key(both, ["shipment_id"], order)


@query(
    "pipe_aligned_records",
    f"""WITH {_TIDY_SQL},
staff_rows AS (SELECT shipment_id, staff_first_name, staff_last_name, role, origin_hub_city
               FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY datasource DESC) AS nth FROM tidy)
               WHERE nth = 1),
records AS (
  SELECT *, CAST(NULL AS DOUBLE) AS shipment_cost, false AS has_timestamp FROM staff_rows
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, o_totalprice, true FROM orders
)
SELECT shipment_id, staff_first_name, staff_last_name, role, origin_hub_city, shipment_cost, has_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY shipment_cost DESC NULLS LAST) AS nth FROM records)
WHERE nth = 1""",
)
def pipe_aligned_records(spark, sf_dir):
    staff = silver_staff(src.source1(spark, sf_dir), src.source2(spark, sf_dir))
    ships = shaping.add_audit(src.shipments(spark, sf_dir)).select("shipment_id", "shipment_cost", "ingestion_timestamp")
    aligned = aligned_records(staff, ships)
    return aligned.withColumn("has_timestamp", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp")


# Delay dashboard


@query(
    "pipe_delay_dashboard",
    f"""WITH {src.STAFF_SQL}, {src.SHIPMENTS_SQL},
top10 AS (SELECT * FROM shipments WHERE shipment_status = 'DELAYED' ORDER BY shipment_cost DESC, shipment_id LIMIT 10)
SELECT shipment_id, order_id, upper(origin_hub_city) AS source_city, CAST(shipment_date AS VARCHAR) AS shipment_date,
       '₹' || format('{{:,.2f}}', shipment_cost) AS shipment_cost_fmt, shipment_cost > 50000 AS is_high_value
FROM top10 JOIN staff USING (staff_id)""",
)
def pipe_delay_dashboard(spark, sf_dir):
    ships = src.shipments(spark, sf_dir)
    problems = ships.where(F.col("shipment_status").isin("DELAYED", "RETURNED"))
    delayed = problems.where("shipment_status = 'DELAYED'")
    top = ordering.top_k(delayed, [F.desc("shipment_cost")], "shipment_id", 10)
    # The report is ten rows before it meets the staff table.
    hubs = src.staff(spark, sf_dir).select("staff_id", "origin_hub_city")
    return hubs.join(F.broadcast(top), "staff_id").select(
        "shipment_id",
        "order_id",
        F.upper("origin_hub_city").alias("source_city"),
        dates.iso_text("shipment_date").alias("shipment_date"),
        text.format_currency("shipment_cost").alias("shipment_cost_fmt"),
        flags.is_high_value("shipment_cost").alias("is_high_value"),
    )


# Gold table


def wide_history(staff: DataFrame, ships: DataFrame) -> DataFrame:
    """Staff, their vehicle master data and all shipments, matched or not, in one wide frame."""
    vehicles = staff.groupBy("vehicle_type").agg(F.count("*").alias("fleet_size"))
    crewed = joins.lookup(staff, vehicles, ["vehicle_type"]).withColumn(
        "vehicle_identifier", text.composite_key("vehicle_type", "staff_id")
    )
    wide = joins.reconcile(crewed, ships, "staff_id")
    return wide.withColumn("ship_year", F.year("shipment_date"))


@query(
    "gold_wide_table",
    f"""WITH {src.STAFF_SQL}, {src.SHIPMENTS_SQL},
crewed AS (SELECT *, count(*) OVER (PARTITION BY vehicle_type) AS fleet_size,
                  vehicle_type || '_' || CAST(staff_id AS VARCHAR) AS vehicle_identifier FROM staff)
SELECT coalesce(c.staff_id, s.staff_id) AS staff_id, c.staff_name, c.age, c.role, c.origin_hub_city, c.vehicle_type,
       c.fleet_size, c.vehicle_identifier, s.order_id, s.shipment_id, s.shipment_status, s.shipment_cost,
       CAST(year(s.shipment_date) AS INTEGER) AS ship_year
FROM crewed c FULL JOIN shipments s ON c.staff_id = s.staff_id""",
)
def gold_wide_table(spark, sf_dir):
    wide = wide_history(src.staff(spark, sf_dir), src.shipments(spark, sf_dir)).drop("shipment_date", "fleet_class")
    name = f"{tables.scratch_schema(spark)}.wide_shipment_history"
    tables.save_table(wide, name, "overwrite", partition_by=("ship_year",))
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})

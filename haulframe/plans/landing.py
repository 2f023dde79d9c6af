"""Queries: sources. Given tables are landed as files in the layout under test and read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from haulframe.operators import quality
from haulframe.plans import inputs as src
from haulframe.plans.registry import query
from haulframe.sources import readers, sinks
from haulframe.sources.scratch import new_path

NAMES = ["id", "name", "loc", "balance", "plan"]
DDL = "id bigint, name string, loc int, balance double, plan string"
STRUCT = StructType(
    [
        StructField("id", LongType(), False),
        StructField("name", StringType(), True),
        StructField("loc", IntegerType(), True),
        StructField("balance", DoubleType(), True),
        StructField("plan", StringType(), True),
    ]
)
CLIENTS_SQL = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS loc, c_acctbal AS balance, c_mktsegment AS plan FROM customer"


def clients(spark, sf_dir):
    return src.table(spark, sf_dir, "customer").toDF(*NAMES)


def land_clients(spark, sf_dir, **options):
    path = new_path(spark, "clients")
    sinks.write_csv(clients(spark, sf_dir), path, **options)
    return path


def land_by_plan(spark, sf_dir):
    """One folder per plan, with CSV files and JSON files side by side."""
    path = new_path(spark, "clients-by-plan")
    rows = clients(spark, sf_dir)
    rows.write.partitionBy("plan").option("header", True).csv(path)
    rows.write.partitionBy("plan").mode("append").json(path)
    return path


def typed(df):
    return df.select(
        F.col("id").cast("bigint").alias("id"),
        "name",
        F.col("loc").cast("int").alias("loc"),
        F.col("balance").cast("double").alias("balance"),
        "plan",
    )


@query(
    "src_csv_raw",
    "SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2, "
    "CAST(c_acctbal AS VARCHAR) AS _c3, c_mktsegment AS _c4 FROM customer",
)
def src_csv_raw(spark, sf_dir):
    return readers.read_csv(spark, land_clients(spark, sf_dir))


@query("src_csv_infer", CLIENTS_SQL)
def src_csv_infer(spark, sf_dir):
    path = land_clients(spark, sf_dir, header=True)
    return typed(readers.read_csv(spark, path, header=True, inferSchema=True))


@query("src_csv_delim", " UNION ALL ".join(f"{CLIENTS_SQL.replace('SELECT', f'SELECT {i} AS kind,', 1)}" for i in (1, 2, 3)))
def src_csv_delim(spark, sf_dir):
    parts = []
    for kind, sep in enumerate(("~", "|", "\t"), 1):
        path = land_clients(spark, sf_dir, header=True, sep=sep)
        part = readers.read_csv(spark, path, DDL, header=True, sep=sep)
        parts.append(part.withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src_reader_styles", " UNION ALL ".join([CLIENTS_SQL] * 3))
def src_reader_styles(spark, sf_dir):
    path = land_clients(spark, sf_dir, header=True, sep="~")
    by_keyword = spark.read.csv(path, schema=DDL, header=True, sep="~")
    by_option = spark.read.option("header", True).option("sep", "~").schema(DDL).format("csv").load(path)
    by_options = readers.read_formatted(spark, "csv", path, DDL, header=True, sep="~")
    return by_keyword.unionByName(by_option).unionByName(by_options)


_PARTS_SQL = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS loc, c_acctbal AS balance FROM customer"
_PARTS_DDL = "id bigint, name string, loc int, balance double"


@query("src_multi_path", f"{_PARTS_SQL} UNION ALL {_PARTS_SQL}")
def src_multi_path(spark, sf_dir):
    root = new_path(spark, "clients-by-plan")
    clients(spark, sf_dir).write.partitionBy("plan").option("header", True).csv(root)
    folders = readers.list_folders(spark, f"{root}/plan=*")
    listed = readers.read_csv(spark, folders, _PARTS_DDL, header=True)
    matched = readers.read_csv(spark, f"{root}/plan=*", _PARTS_DDL, header=True)
    return listed.unionByName(matched)


@query("src_path_glob", CLIENTS_SQL)
def src_path_glob(spark, sf_dir):
    root = land_by_plan(spark, sf_dir)
    return readers.read_csv(spark, root, f"{_PARTS_DDL}, plan string", header=True, pathGlobFilter="*.csv")


@query("src_recursive", _PARTS_SQL)
def src_recursive(spark, sf_dir):
    root = land_by_plan(spark, sf_dir)
    return readers.read_csv(
        spark, root, _PARTS_DDL, header=True, pathGlobFilter="*.csv", recursiveFileLookup=True
    )


@query("src_schema_ddl", CLIENTS_SQL)
def src_schema_ddl(spark, sf_dir):
    return readers.read_csv(spark, land_clients(spark, sf_dir, header=True), DDL, header=True)


@query("src_schema_struct", CLIENTS_SQL)
def src_schema_struct(spark, sf_dir):
    return readers.read_csv(spark, land_clients(spark, sf_dir, header=True), STRUCT, header=True)


MICROSECONDS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EVENT_STRUCT = StructType(
    [
        StructField("event_id", LongType(), False),
        StructField("ts", TimestampNTZType(), False),
        StructField("user_id", LongType(), False),
        StructField("event_type", StringType(), False),
    ]
)


@query(
    "src_schema_timestamp",
    "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events",
)
def src_schema_timestamp(spark, sf_dir):
    # Without a format, times are written to the millisecond.
    options = {"sep": "|", "header": True, "timestampNTZFormat": MICROSECONDS}
    path = new_path(spark, "events")
    events = src.table(spark, sf_dir, "events").select(*EVENT_STRUCT.names)
    sinks.write_csv(events, path, **options)
    rows = readers.read_csv(spark, path, EVENT_STRUCT, **options)
    return rows.select("event_id", "user_id", "event_type", F.date_format("ts", MICROSECONDS).alias("ts_text"))


@query("src_csv_head", f"{CLIENTS_SQL} ORDER BY id LIMIT 5")
def src_csv_head(spark, sf_dir):
    rows = readers.read_csv(spark, land_clients(spark, sf_dir, header=True), DDL, header=True)
    return rows.orderBy("id").limit(5)


@query("src_inline_csv", CLIENTS_SQL)
def src_inline_csv(spark, sf_dir):
    lines = clients(spark, sf_dir).select(F.to_csv(F.struct(*NAMES)).alias("value"))
    return readers.parse_lines(lines, DDL)


# Malformed lines. Nation keys decide which line gets which fault.

DIRTY_NAMES = ["id", "firstname", "lastname", "age", "profession"]
DIRTY_STRUCT = StructType(
    [
        StructField("id", IntegerType()),
        StructField("firstname", StringType()),
        StructField("lastname", StringType()),
        StructField("age", ShortType()),
        StructField("profession", StringType()),
    ]
)


def dirty_lines(spark, sf_dir):
    place = F.col("c_nationkey")
    name = F.split("c_name", "#")
    head = F.concat_ws(
        ",",
        F.when(place == 8, F.concat(F.lit("X"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string")),
        name[0],
        F.when(place == 7, "").otherwise(F.concat(F.lit("N"), name[1])),
        F.when(place.isin(5, 6), "ten").otherwise(src.age_of().cast("string")),
    )
    tail = (
        F.when(place <= 2, "")
        .when(place.isin(3, 4), F.concat(F.lit(","), F.col("c_mktsegment"), F.lit(",extra")))
        .when(place == 7, ",")
        .otherwise(F.concat(F.lit(","), F.col("c_mktsegment")))
    )
    return src.table(spark, sf_dir, "customer").select(F.concat(head, tail).alias("value"))


def land_dirty(spark, sf_dir):
    path = new_path(spark, "dirty")
    sinks.write_files(dirty_lines(spark, sf_dir), path, "text")
    return path


_DIRTY_SQL = f"""
SELECT CASE WHEN c_nationkey <> 8 THEN CAST(c_custkey AS INTEGER) END AS id,
       split_part(c_name, '#', 1) AS firstname,
       CASE WHEN c_nationkey <> 7 THEN 'N' || split_part(c_name, '#', 2) END AS lastname,
       CASE WHEN c_nationkey NOT IN (5, 6) THEN {src.AGE_SQL} END AS age,
       CASE WHEN c_nationkey > 2 AND c_nationkey <> 7 THEN c_mktsegment END AS profession
FROM customer"""


@query("src_permissive", _DIRTY_SQL)
def src_permissive(spark, sf_dir):
    rows = readers.read_csv(spark, land_dirty(spark, sf_dir), DIRTY_STRUCT, mode="PERMISSIVE")
    return rows.withColumn("age", F.col("age").cast("int"))


@query("src_dropmalformed", f"{_DIRTY_SQL} WHERE c_nationkey = 7 OR c_nationkey > 8")
def src_dropmalformed(spark, sf_dir):
    rows = readers.read_valid_csv(spark, land_dirty(spark, sf_dir), DIRTY_STRUCT)
    return rows.withColumn("age", F.col("age").cast("int"))


@query(
    "src_string_staging",
    f"""
SELECT CASE WHEN c_nationkey = 8 THEN 'X' ELSE '' END || CAST(c_custkey AS VARCHAR) AS id,
       split_part(c_name, '#', 1) AS firstname,
       CASE WHEN c_nationkey <> 7 THEN 'N' || split_part(c_name, '#', 2) END AS lastname,
       CASE WHEN c_nationkey IN (5, 6) THEN 'ten' ELSE CAST({src.AGE_SQL} AS VARCHAR) END AS age,
       CASE WHEN c_nationkey > 2 AND c_nationkey <> 7 THEN c_mktsegment END AS profession
FROM customer""",
)
def src_string_staging(spark, sf_dir):
    return readers.read_csv(spark, land_dirty(spark, sf_dir), readers.text_schema(DIRTY_NAMES))


@query("dq_fewer_columns", "SELECT count(*) AS fewer FROM customer WHERE c_nationkey <= 2")
def dq_fewer_columns(spark, sf_dir):
    lines = spark.read.text(land_dirty(spark, sf_dir))
    return quality.count_by_width(lines, len(DIRTY_NAMES)).select("fewer")


@query("dq_more_columns", "SELECT count(*) AS more FROM customer WHERE c_nationkey IN (3, 4)")
def dq_more_columns(spark, sf_dir):
    lines = spark.read.text(land_dirty(spark, sf_dir))
    return quality.count_by_width(lines, len(DIRTY_NAMES)).select("more")


@query(
    "pipe_dirty_compare",
    "SELECT 'permissive' AS treatment, count(*) AS kept, count(*) FILTER (c_nationkey IN (5, 6)) AS age_missing, "
    "count(*) FILTER (c_nationkey <= 2 OR c_nationkey = 7) AS profession_missing FROM customer UNION ALL "
    "SELECT 'dropmalformed', count(*), 0, count(*) FILTER (c_nationkey = 7) FROM customer "
    "WHERE c_nationkey = 7 OR c_nationkey > 8 UNION ALL "
    "SELECT 'staged', count(*), count(*) FILTER (c_nationkey IN (5, 6)), "
    "count(*) FILTER (c_nationkey <= 2 OR c_nationkey = 7) FROM customer",
)
def pipe_dirty_compare(spark, sf_dir):
    path = land_dirty(spark, sf_dir)
    staged = readers.read_csv(spark, path, readers.text_schema(DIRTY_NAMES))
    treatments = {
        "permissive": readers.read_csv(spark, path, DIRTY_STRUCT, mode="PERMISSIVE"),
        "dropmalformed": readers.read_valid_csv(spark, path, DIRTY_STRUCT),
        "staged": staged.withColumn("age", F.col("age").try_cast("smallint")),
    }
    rows = [
        df.agg(
            F.count("*").alias("kept"),
            F.count_if(F.col("age").isNull()).alias("age_missing"),
            F.count_if(F.col("profession").isNull()).alias("profession_missing"),
        ).select(F.lit(name).alias("treatment"), "kept", "age_missing", "profession_missing")
        for name, df in treatments.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# JSON, Parquet, text, listings


@query(
    "src_json_lines",
    "SELECT c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name, c_acctbal < 0 AS is_corrupt FROM customer",
)
def src_json_lines(spark, sf_dir):
    # Documents of clients in debt are cut short, which makes them unreadable.
    document = F.to_json(F.struct("id", "name", "balance"))
    lines = clients(spark, sf_dir).select(
        F.when(F.col("balance") < 0, F.substring(document, 1, 40)).otherwise(document).alias("value")
    )
    path = new_path(spark, "json-lines")
    sinks.write_files(lines, path, "text")
    rows = readers.read_json_lines(spark, path, "id bigint, name string, balance double")
    corrupt = F.col(readers.CORRUPT)
    return rows.select(
        F.coalesce("id", F.regexp_extract(corrupt, r'"id":(\d+)', 1).try_cast("bigint")).alias("id"),
        "name",
        corrupt.isNotNull().alias("is_corrupt"),
    )


@query("src_json_multiline", CLIENTS_SQL)
def src_json_multiline(spark, sf_dir):
    path = new_path(spark, "json-documents")
    sinks.write_json_documents(clients(spark, sf_dir), path, "id")
    return readers.read_json_documents(spark, path, DDL).select(*NAMES)


@query("src_parquet", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 25")
def src_parquet(spark, sf_dir):
    lines = readers.read_formatted(spark, "parquet", f"{sf_dir}/lineitem.parquet")
    return lines.where("l_quantity > 25").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query(
    "src_file_inventory",
    "SELECT DISTINCT c_mktsegment AS plan, e.extension, true AS has_bytes FROM customer, "
    "(VALUES ('csv'), ('json')) e(extension)",
)
def src_file_inventory(spark, sf_dir):
    files = readers.list_files(spark, land_by_plan(spark, sf_dir), recursiveFileLookup=True)
    return files.groupBy(
        F.regexp_extract("path", "plan=([A-Z]+)", 1).alias("plan"),
        F.regexp_extract("path", r"\.([a-z]+)$", 1).alias("extension"),
    ).agg((F.min("length") > 0).alias("has_bytes"))


@query(
    "src_text_preview",
    "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') || ',' || c_name AS value FROM customer ORDER BY value LIMIT 5",
)
def src_text_preview(spark, sf_dir):
    lines = clients(spark, sf_dir).select(
        F.concat_ws(",", F.lpad(F.col("id").cast("string"), 12, "0"), "name").alias("value")
    )
    path = new_path(spark, "text")
    sinks.write_files(lines, path, "text")
    return readers.preview_text(spark, path, 5)

"""Queries: managed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulframe.operators import params, shaping
from haulframe.plans import inputs as src
from haulframe.plans.landing import CLIENTS_SQL, clients
from haulframe.plans.registry import query
from haulframe.sources import readers, sinks, tables
from haulframe.sources.scratch import new_path


@query("tbl_managed", CLIENTS_SQL)
def tbl_managed(spark, sf_dir):
    name = f"{tables.scratch_schema(spark)}.clients"
    tables.save_table(clients(spark, sf_dir).where("balance > 0"), name)
    tables.save_table(clients(spark, sf_dir), name, "overwrite")
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})


@query("tbl_ctas_empty", "SELECT count(*) AS source_rows, 0 AS clone_rows, 5 AS clone_columns FROM customer")
def tbl_ctas_empty(spark, sf_dir):
    schema = tables.scratch_schema(spark)
    tables.save_table(clients(spark, sf_dir), f"{schema}.clients1")
    tables.empty_clone(spark, f"{schema}.clients1", f"{schema}.clients2")
    clone = spark.table(f"{schema}.clients2")
    rows = spark.table(f"{schema}.clients1").select(F.lit(1).alias("source"))
    both = rows.unionAll(clone.select(F.lit(0).alias("source")))
    return both.agg(
        F.count_if(F.col("source") == 1).alias("source_rows"),
        F.count_if(F.col("source") == 0).alias("clone_rows"),
        F.lit(len(clone.columns)).alias("clone_columns"),
    )


@query("tbl_insert_overwrite", CLIENTS_SQL)
def tbl_insert_overwrite(spark, sf_dir):
    schema = tables.scratch_schema(spark)
    rows = clients(spark, sf_dir)
    tables.save_table(rows, f"{schema}.clients1")
    tables.empty_clone(spark, f"{schema}.clients1", f"{schema}.clients2")
    tables.replace_rows(rows.where("balance > 0"), f"{schema}.clients2")
    tables.replace_rows(rows.select("plan", "balance", "loc", "name", "id"), f"{schema}.clients2")
    return spark.table(f"{schema}.clients2")


@query(
    "tbl_show_create",
    "SELECT ddl.*, (SELECT count(*) FROM customer) AS table_rows FROM (VALUES ('id', 'BIGINT'), ('name', 'STRING'), "
    "('loc', 'INT'), ('balance', 'DOUBLE'), ('plan', 'STRING')) ddl(column_name, data_type)",
)
def tbl_show_create(spark, sf_dir):
    name = f"{tables.scratch_schema(spark)}.clients"
    tables.save_table(clients(spark, sf_dir), name)
    ddl = tables.table_ddl(spark, name)
    lines = ddl.select(F.explode(F.split("createtab_stmt", "\n")).alias("line"))
    column = r"^  (\w+) ([A-Z]+)"
    columns = lines.where(F.col("line").rlike(column)).select(
        F.regexp_extract("line", column, 1).alias("column_name"), F.regexp_extract("line", column, 2).alias("data_type")
    )
    # one line per column of the table
    named = [F.struct(F.lit(r[0]).alias("column_name"), F.lit(r[1]).alias("data_type")) for r in columns.collect()]
    counted = spark.table(name).agg(F.count("*").alias("table_rows"))
    return counted.select(F.inline(F.array(*named)), "table_rows")


@query("tbl_drop", "SELECT count(*) AS source_rows, true AS gone FROM customer")
def tbl_drop(spark, sf_dir):
    name = f"{tables.scratch_schema(spark)}.clients"
    tables.save_table(clients(spark, sf_dir), name)
    gone = tables.drop_table(spark, name)
    return clients(spark, sf_dir).agg(F.count("*").alias("source_rows"), F.lit(gone).alias("gone"))


@query("param_table_query", f"{CLIENTS_SQL} ORDER BY id LIMIT 10")
def param_table_query(spark, sf_dir):
    name = f"{tables.scratch_schema(spark)}.clients"
    tables.save_table(clients(spark, sf_dir), name)
    return params.table_head(spark, name, "id", 10)


@query("pipe_csv_to_table", "SELECT p_partkey AS part_key, p_size AS size_Percent, p_brand AS brand_type FROM part")
def pipe_csv_to_table(spark, sf_dir):
    path = new_path(spark, "messy-names")
    messy = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part key"), F.col("p_size").alias("size %"), F.col("p_brand").alias("brand/type")
    )
    sinks.write_csv(messy, path, header=True)
    landed = readers.read_csv(spark, path, header=True, inferSchema=True)
    name = f"{tables.scratch_schema(spark)}.parts"
    tables.save_table(shaping.sanitize_names(landed), name)
    return spark.sql(
        "SELECT CAST(part_key AS BIGINT) AS part_key, size_Percent, brand_type FROM IDENTIFIER(:t)", args={"t": name}
    )

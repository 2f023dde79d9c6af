"""Managed tables in the session catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulframe.sources.scratch import new_path


def scratch_schema(spark: SparkSession) -> str:
    """A new schema whose managed tables live in the shared folder, whatever the warehouse setting."""
    name = f"haul_{uuid.uuid4().hex[:12]}"
    location = new_path(spark, "schema")
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name) LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'", args={"name": name})
    return name


def save_table(df: DataFrame, table: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Save as a managed table.

    A partitioned table is first rebalanced by its partition columns: few files per partition, and
    a large partition is spread over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def empty_clone(spark: SparkSession, source: str, target: str) -> None:
    """An empty table with the columns of another."""
    spark.sql(
        "CREATE TABLE IF NOT EXISTS IDENTIFIER(:target) USING parquet AS SELECT * FROM IDENTIFIER(:source) WHERE 1 = 0",
        args={"target": target, "source": source},
    )


def replace_rows(df: DataFrame, table: str) -> None:
    """Overwrite the rows of a table. Columns go by position, so they are first put in table order."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def drop_table(spark: SparkSession, table: str) -> bool:
    """Drop a table; True when it is gone."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": table})
    return not spark.catalog.tableExists(table)


def table_ddl(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql("SHOW CREATE TABLE IDENTIFIER(:table)", args={"table": table})

"""Intermediate tables, written once to the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulframe.sources.scratch import new_path


def columns_of(df: DataFrame) -> list[Column]:
    """All columns by name, whatever characters the names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def landed(df: DataFrame, label: str) -> DataFrame:
    """The rows, written as Parquet and read again: later steps start from files that outlive any executor."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a landed table that nothing reads any more: what was made of it has been written itself."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, first: int = 0) -> tuple[DataFrame, str]:
    """The rows with a number of their own from ``first`` on, written so that it stays, and its column's name.

    The name is one that the rows do not have yet. Numbers grow but leave gaps.
    """
    name = "_row"
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return landed(df.withColumn(name, F.monotonically_increasing_id() + F.lit(first)), "numbered"), name

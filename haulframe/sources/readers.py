"""Readers for delimited text, JSON, XML, Parquet, ORC, tables and folder listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

Schema = str | StructType
Paths = str | Sequence[str]


def text_schema(columns: Sequence[str]) -> StructType:
    """All columns as text: nothing is lost on reading, and values are cast later."""
    return StructType([StructField(name, StringType()) for name in columns])


def read_csv(spark: SparkSession, paths: Paths, schema: Schema | None = None, **options: object) -> DataFrame:
    """Delimited text. Without a schema the columns are text, unless ``inferSchema`` is asked for.

    Options are those of Spark: ``header``, ``sep``, ``mode``, ``pathGlobFilter``,
    ``recursiveFileLookup``, ``inferSchema`` and so on.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_valid_csv(spark: SparkSession, paths: Paths, schema: StructType, **options: object) -> DataFrame:
    """Only the rows in which every field is there and fits its type.

    Spark converts just the fields a query needs, so a bare count would keep rows with a bad value.
    The filter is always true; it makes every query, counts too, need all fields.
    """
    rows = read_csv(spark, paths, schema, mode="DROPMALFORMED", **options)
    return rows.where(F.hash(*rows.columns) >= F.lit(-(2**31)))


def read_formatted(spark: SparkSession, fmt: str, paths: Paths, schema: Schema | None = None, **options: object) -> DataFrame:
    """The generic reader: format by name, options, paths."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths if isinstance(paths, str) else list(paths))


def read_json_lines(spark: SparkSession, paths: Paths, schema: str) -> DataFrame:
    """One document per line; a broken one gives a row with its text in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, {CORRUPT} string").json(paths)


def read_json_documents(spark: SparkSession, paths: Paths, schema: Schema | None = None) -> DataFrame:
    """Files that each hold one JSON document over several lines."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


def read_xml(spark: SparkSession, paths: Paths, row_tag: str, schema: Schema | None = None) -> DataFrame:
    """Give a schema to fix the column order; inference sorts the columns by name."""
    return read_formatted(spark, "xml", paths, schema, rowTag=row_tag)


def list_files(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Path, time and size of the files in a folder. The content column is never read."""
    files = read_formatted(spark, "binaryFile", path, **options)
    return files.select("path", "modificationTime", "length")


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold the files a path names, in order. There are as many as partitions of the data."""
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    return sorted(r.folder for r in list_files(spark, path).select(folder).distinct().collect())


def preview_text(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` lines of the files as they are stored, in file order.

    ``head`` reads the first file and goes on to others only while lines are lacking, so nothing is
    sorted and the rest is not read. What comes to the driver is ``n`` lines.
    """
    lines = spark.read.text(path)
    return spark.createDataFrame(lines.head(n), lines.schema)


def parse_lines(lines: DataFrame, schema: str, line: str = "value", sep: str = ",") -> DataFrame:
    """Delimited lines held in a column, parsed without files."""
    parsed = F.from_csv(F.col(line), schema, {"sep": sep})
    return lines.select(parsed.alias("_row")).select("_row.*")

"""Projection steps that need more than one API call."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters replaced in column names.
NAME_REPLACEMENTS = {" ": "_", "%": "Percent", "/": "_"}


def clean_name(name: str) -> str:
    for old, new in NAME_REPLACEMENTS.items():
        name = name.replace(old, new)
    return name


def sanitize_names(df: DataFrame) -> DataFrame:
    """Make all column names usable in a table; two names may not end up the same."""
    names = [clean_name(name) for name in df.columns]
    clashes = [name for name, n in Counter(name.lower() for name in names).items() if n > 1]
    if clashes:
        raise ValueError(f"column names collide after clean-up: {clashes}")
    return df.toDF(*names)


def tag_source(df: DataFrame, source: str, column: str = "datasource") -> DataFrame:
    return df.withColumn(column, F.lit(source))


def add_audit(df: DataFrame, domain: str = "logistics") -> DataFrame:
    """Domain, ingestion time and the not-yet-known expedited flag."""
    return df.withColumns(
        {
            "domain": F.lit(domain),
            "ingestion_timestamp": F.current_timestamp(),
            "is_expedited": F.lit("False").cast("boolean"),
        }
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows with the number of non-null values: one scan, one row per column."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(entries))

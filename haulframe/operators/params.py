"""Run parameters as checked arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_head(spark: SparkSession, table: str, order: str, limit: int = 10) -> DataFrame:
    """First rows of a table named at run time. The name is bound as an identifier, not spliced in."""
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:tbl) ORDER BY IDENTIFIER(:ord) LIMIT :n",
        args={"tbl": table, "ord": order, "n": limit},
    )


def choose_many(df: DataFrame, column: str, choice: str, choices: Sequence[str]) -> DataFrame:
    """Rows matching any value of a comma-separated choice; unknown values are refused."""
    picked = [value.strip() for value in choice.split(",")]
    unknown = sorted(set(picked) - set(choices))
    if unknown:
        raise ValueError(f"not among the choices: {unknown}")
    return df.where(F.col(column).isin(*picked))


def choose_one(df: DataFrame, column: str, choices: Sequence[str], choice: str | None = None) -> DataFrame:
    """Rows matching one value; the first choice is the default."""
    value = choices[0] if choice is None else choice
    if value not in choices:
        raise ValueError(f"not among the choices: {value}")
    return df.where(F.col(column) == value)

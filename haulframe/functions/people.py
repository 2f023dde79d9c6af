"""Staff rules: bonus and name masking.

Each rule is a native expression. The Arrow-batched forms give the same values and exist for callers
who need a function they can register for SQL.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Salaries, shares and age limits of the bonus rule.
SENIOR_SALARY, JUNIOR_SALARY = 20_000.0, 10_000.0
SENIOR_SHARE, JUNIOR_SHARE = 0.15, 0.05
SENIOR_ABOVE, JUNIOR_BELOW = 50, 30


def bonus(role: str = "role", age: str = "age") -> Column:
    """Drivers over 50 get the senior bonus, under 30 the junior one; everybody else 0.0."""
    driver = F.col(role) == "driver"
    return (
        F.when(driver & (F.col(age) > SENIOR_ABOVE), F.lit(SENIOR_SALARY * SENIOR_SHARE))
        .when(driver & (F.col(age) < JUNIOR_BELOW), F.lit(JUNIOR_SALARY * JUNIOR_SHARE))
        .otherwise(F.lit(0.0))
    )


def mask_name(name: str) -> Column:
    """``Kristina`` gives ``Kr****a``; null and names under three letters stay."""
    col = F.col(name)
    masked = F.concat(F.substring(col, 1, 2), F.lit("****"), F.substring(col, -1, 1))
    return F.when(F.length(col) >= 3, masked).otherwise(col)


@F.pandas_udf(DoubleType())
def bonus_arrow(role: pd.Series, age: pd.Series) -> pd.Series:
    driver = role.eq("driver")
    pay = pd.Series(0.0, index=role.index)
    pay[driver & age.gt(SENIOR_ABOVE)] = SENIOR_SALARY * SENIOR_SHARE
    pay[driver & age.lt(JUNIOR_BELOW)] = JUNIOR_SALARY * JUNIOR_SHARE
    return pay


@F.pandas_udf(StringType())
def mask_name_arrow(name: pd.Series) -> pd.Series:
    masked = name.str[:2] + "****" + name.str[-1:]
    return masked.where(name.str.len() >= 3, name)


def register(spark: SparkSession) -> None:
    """Make the Arrow forms callable from SQL."""
    spark.udf.register("projected_bonus", bonus_arrow)
    spark.udf.register("mask_name", mask_name_arrow)

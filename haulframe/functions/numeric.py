"""Money, weights and ratios. Amounts are added up as decimals, so totals do not depend on row order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TAX_RATE = "0.18"
LARGEST_AMOUNT = 1e12


def money(amount: str | Column) -> Column:
    """The amount as an exact decimal with two places."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return col.cast("decimal(18,2)")


def exact(amount: str | Column, scale: int = 6) -> Column:
    """The amount as a decimal with ``scale`` places, to be added up exactly in any order.

    NaN and infinity are no amounts: they count as not given, in totals and in averages.
    """
    col = F.col(amount) if isinstance(amount, str) else amount
    return col.cast(f"decimal(18,{scale})")


def rounded(total: Column, places: int = 2) -> Column:
    """A decimal total, rounded once, halves away from zero, and handed back as a double."""
    return F.round(total, places).cast("double")


def _units(amount: str | Column) -> tuple[Column, Column]:
    """Whole units and millionths of an amount, as bigints; neither is given for NaN and infinity."""
    col = F.col(amount) if isinstance(amount, str) else amount
    size = F.abs(col)
    too_large = F.when(size < F.lit(float("inf")), F.raise_error(F.lit(f"amount of {LARGEST_AMOUNT:.0f} or more")).cast("bigint"))
    whole = F.when(size < LARGEST_AMOUNT, F.floor(col).cast("bigint")).otherwise(too_large)
    return whole, F.round((col - whole) * 1000000).cast("bigint")


def partial_sums(name: str, amount: str | Column) -> list[Column]:
    """The exact total of amounts with six places as two bigint sums, which are cheaper to add up than decimals."""
    whole, millionths = _units(amount)
    return [F.sum(whole).alias(f"{name}_units"), F.sum(millionths).alias(f"{name}_millionths")]


def merged_sums(name: str) -> list[Column]:
    """Partial sums added up again."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("units", "millionths")]


def _total(units: Column, millionths: Column) -> Column:
    return units.cast("decimal(19,0)") + millionths.cast("decimal(19,0)") * F.lit(Decimal("0.000001"))


def total_of(name: str) -> Column:
    """The total that partial sums stand for, as a decimal with six places."""
    return _total(F.col(f"{name}_units"), F.col(f"{name}_millionths"))


def exact_sum(amount: str | Column) -> Column:
    """Exact total of amounts with six places, as a decimal."""
    whole, millionths = _units(amount)
    return _total(F.sum(whole), F.sum(millionths))


def money_sum(amount: str | Column) -> Column:
    """Exact total of amounts with up to six places; only the total is rounded."""
    return rounded(exact_sum(amount))


def money_avg(amount: str) -> Column:
    """Exact total, not rounded, over the count of amounts, as a double."""
    return exact_sum(amount).cast("double") / F.count(_units(amount)[0])


def round_money(amount: Column) -> Column:
    """Two decimal places, halves away from zero, for an exact decimal input."""
    return F.round(amount, 2).cast("double")


def cost_per_kg(cost: str, weight: str) -> Column:
    """Null when the weight is zero or missing."""
    return F.try_divide(F.col(cost), F.col(weight))


def tax_amount(cost: str, rate: str = TAX_RATE) -> Column:
    return round_money(money(cost) * F.lit(rate).cast("decimal(4,2)"))

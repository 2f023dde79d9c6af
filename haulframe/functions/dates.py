"""Dates: parsing of mixed layouts, parts, weekend flag, age in days."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts seen in the landing files, two-digit years first.
LAYOUTS = ("dd-MM-yy", "dd-MM-yyyy", "yyyy/MM/dd", "yyyy-MM-dd")

SATURDAY, SUNDAY = 7, 1


def _shape(layout: str) -> str:
    """The pattern of texts in a layout: its letters stand for digits."""
    return "^" + re.sub("[A-Za-z]", r"\\d", layout) + "$"


def parse_date(text: str, layouts: tuple[str, ...] = LAYOUTS, latest: str | None = None) -> Column:
    """The first layout that fits; null when none does, or when there is no such day.

    A text is only parsed in a layout whose shape it has: a parse that fails is far dearer than the
    look at the shape. A two-digit year is read as 20xx, or as 19xx where ``latest`` is given and the
    day would lie after it. Four-digit years are taken as they are.
    """
    return F.coalesce(*[F.when(F.col(text).rlike(_shape(x)), _parsed(text, x, latest)) for x in layouts])


def _parsed(text: str, layout: str, latest: str | None) -> Column:
    if latest is None or "yy" not in layout or "yyyy" in layout:
        return F.try_to_date(text, layout)
    at, full = layout.index("yy") + 1, layout.replace("yy", "yyyy")
    head, tail = F.substring(text, 1, at - 1), F.substring(text, at, len(layout))
    this, last = (F.try_to_date(F.concat(head, F.lit(century), tail), full) for century in ("20", "19"))
    # compared as texts: the day may exist in one century only
    late = F.concat(F.lit("20"), F.substring(text, at, 2)) > latest[:4]
    return F.when(late, last).when(this > F.lit(latest).cast("date"), last).otherwise(this)


def iso_text(date: str | Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def is_weekend(date: str) -> Column:
    return F.coalesce(F.dayofweek(F.col(date).cast("date")).isin(SUNDAY, SATURDAY), F.lit(False))


def days_since(date: str, as_of: str | Column | None = None) -> Column:
    """Whole days from the date to ``as_of``; today when no day is given."""
    end = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.datediff(end, F.col(date).cast("date"))

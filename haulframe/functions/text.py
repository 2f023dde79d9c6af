"""Text columns: case, merging, splitting, currency, pattern tests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUPEE = "₹"


def standard_case(
    df: DataFrame,
    lower: tuple[str, ...] = (),
    upper: tuple[str, ...] = (),
    title: tuple[str, ...] = (),
) -> DataFrame:
    """Bring text columns to one case, all in a single projection.

    Only text columns may be named: lower-casing a number would silently turn it into text.
    """
    kinds = dict(df.dtypes)
    wanted = [(name, F.lower) for name in lower]
    wanted += [(name, F.upper) for name in upper]
    wanted += [(name, F.initcap) for name in title]
    for name, _ in wanted:
        if kinds.get(name) != "string":
            raise TypeError(f"{name} is {kinds.get(name)}, not a text column")
    return df.withColumns({name: change(F.col(name)) for name, change in wanted})


def full_name(*parts: str) -> Column:
    """Join name parts with a space; missing parts are skipped."""
    return F.concat_ws(" ", *parts)


def route_segment(origin: str, destination: str) -> Column:
    """``Chennai`` and ``Pune`` give ``Chennai-Pune``; null when either is missing."""
    return F.concat(F.col(origin), F.lit("-"), F.col(destination))


def composite_key(kind: str, identifier: str) -> Column:
    """``Truck`` and ``500001`` give ``Truck_500001``; null when either is missing."""
    return F.concat(F.col(kind), F.lit("_"), F.col(identifier).cast("string"))


def code_prefix(code: str, width: int = 3) -> Column:
    return F.substring(F.col(code), 1, width)


def code_sequence(code: str, width: int = 3) -> Column:
    return F.col(code).substr(F.lit(width + 1), F.length(code))


def first_word(text: str) -> Column:
    return F.element_at(F.split(F.col(text), " "), 1)


def last_word(text: str) -> Column:
    return F.element_at(F.split(F.col(text), " "), -1)


def format_currency(amount: str, sign: str = RUPEE) -> Column:
    """30695.8 gives ``₹30,695.80``."""
    return F.concat(F.lit(sign), F.format_number(F.col(amount), 2))


def _amount_pattern(decimal: str) -> tuple[str, str]:
    """A pattern with three groups (before, number, after), and the characters that may group digits."""
    point, other = re.escape(decimal), "." if decimal == "," else ","
    group = f"[{re.escape(other)}'\u00A0\u202F ]"
    space, sign = "[\\s\u00A0\u202F]*+", "[+\\-\u2212]?+"
    unit = f"(?:[^\\d\\s\\p{{Cntrl}}\u00A0\u202F.,'()+\\-\u2212]++\\.?+{space})*+"
    digits = f"(?:\\d{{1,3}}(?:{group}\\d{{2,3}})*{group}\\d{{3}}(?!\\d)|\\d++)"
    number = f"(?:{digits}(?:{point}\\d*+)?+|{point}\\d++)(?:[eE][+-]?+\\d++)?+"
    before = f"{space}\\(?+{space}{sign}{space}{unit}{sign}{space}"
    after = f"{space}{unit}{sign}{space}\\)?+{space}"
    return f"^({before})({number})({after})$", group


def parse_currency(text: str, decimal: str = ".") -> Column:
    """The amount in a formatted currency text; null when the whole text is not one amount.

    An amount is a number with a unit (``₹``, ``Rs.``, ``EUR``) before or after it. ``decimal`` is the
    decimal mark, ``.`` or ``,``. The other of the two, an apostrophe or a space may group the digits before
    it, in twos or threes, the last group in threes (``1,00,000.50``). One sign, before or after the unit or at
    the end, or accounting brackets give its sign: ``-5``, ``₹-5``, ``5-`` and ``(5)`` are -5. More than one of
    these, or one bracket alone, is no amount. A number may have an exponent: ``1e3`` is 1000.
    """
    if decimal not in (".", ","):
        raise ValueError("the decimal mark is a point or a comma")
    pattern, group = _amount_pattern(decimal)
    before, number, after = (F.regexp_extract(F.col(text), pattern, i) for i in (1, 2, 3))
    size = F.regexp_replace(F.regexp_replace(number, group, ""), re.escape(decimal), ".").try_cast("double")
    signs = F.regexp_replace(F.concat(before, after), "[^()+\\-\u2212]", "")
    return F.when(signs.isin("", "+"), size).when(signs.isin("-", "\u2212", "()"), -size)


def has_non_digit(text: str) -> Column:
    return F.col(text).rlike("[^0-9]")


def is_whole_number(text: str) -> Column:
    return F.col(text).rlike(r"^\d+$")

"""Data quality: mandatory columns, defaults, normalisation, field counts, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Age texts that mean "not given", and vehicle names brought to one form.
AGE_DEFAULT = "-1"
AGE_WORDS = {"ten": "-1", "": "-1"}
VEHICLE_DEFAULT = "UNKNOWN"
VEHICLE_WORDS = {"truck": "LMV", "bike": "TwoWheeler"}


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which all the columns are given."""
    return df.na.drop(how="any", subset=list(columns))


def require_one_of(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which at least one of the columns is given."""
    return df.na.drop(how="all", subset=list(columns))


def fill_text(df: DataFrame, default: str, *columns: str) -> DataFrame:
    """Fill nulls of text columns. Spark ignores a text default on other types, so those are refused."""
    kinds = dict(df.dtypes)
    wrong = [name for name in columns if kinds.get(name) != "string"]
    if wrong:
        raise TypeError(f"not text columns: {wrong}")
    return df.na.fill(default, subset=list(columns))


def replace_any_case(df: DataFrame, column: str, words: dict[str, str]) -> DataFrame:
    """Replace whole values, comparing without regard to case."""
    result: Column = F.col(column)
    for old, new in words.items():
        result = F.when(F.lower(F.col(column)) == old.lower(), F.lit(new)).otherwise(result)
    return df.withColumn(column, result)


def scrub_staff(df: DataFrame) -> DataFrame:
    """Age and vehicle defaults, invalid ages, vehicle names."""
    df = fill_text(df, AGE_DEFAULT, "age")
    df = fill_text(df, VEHICLE_DEFAULT, "vehicle_type")
    df = df.na.replace(AGE_WORDS, subset=["age"])
    return replace_any_case(df, "vehicle_type", VEHICLE_WORDS)


END = "\uE000end of line\uE000"  # put behind a line as one more field


def field_count(line: str, sep: str = ",", quote: str = '"', escape: str = "\\", most: int = 64) -> Column:
    """Number of fields in a raw line as Spark's reader counts them with the same separator, quote and escape.

    Its own parser does the counting: the line gets one more field with a known text, and the place where that
    text turns up says how many fields stand before it; where it is swallowed by a quote that never closes, it
    ends the last field. ``most`` + 1 stands for any larger number. Null for a line that the reader skips
    (blank) and for a null. Records that run over several lines are for the multi-line reader.
    """
    names = [f"f{i}" for i in range(most + 1)]
    marked = F.concat(F.replace(F.col(line), F.lit(END), F.lit("")), F.lit(sep + END))
    schema = ", ".join(f"{name} string" for name in names)
    row = F.from_csv(marked, schema, {"sep": sep, "quote": quote, "escape": escape})

    def width(fields: Column) -> Column:
        found = F.lit(most + 1)
        for i in reversed(range(most + 1)):
            swallowed = F.when(F.endswith(fields[names[i]], F.lit(END)), F.lit(i + 1))
            found = F.when(fields[names[i]] == END, F.lit(i)).otherwise(F.coalesce(swallowed, found))
        return found

    # the row is parsed once; an array is the way to use it several times
    return F.when(F.col(line).rlike("[^\\x00-\\x20]"), F.transform(F.array(row), width)[0])


def count_by_width(
    lines: DataFrame, expected: int, line: str = "value", sep: str = ",", quote: str = '"', escape: str = "\\"
) -> DataFrame:
    """One row: how many lines are short, right and long. Lines that the reader skips are not counted."""
    widths = lines.select(field_count(line, sep, quote, escape, expected).alias("width"))
    return widths.agg(
        F.count_if(F.col("width") < expected).alias("fewer"),
        F.count_if(F.col("width") == expected).alias("exact"),
        F.count_if(F.col("width") > expected).alias("more"),
    )


def dedup_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key in the given order, which must be total to be repeatable.

    Spark limits each group to one row before the shuffle, so a key with a large share of the rows
    sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def matches_in(df: DataFrame, other: DataFrame, key: str, name: str = "matches") -> DataFrame:
    """Rows whose key also occurs in ``other``, with the number of rows it has there.

    ``other`` is counted per key first: the result never grows with repeats on both sides.
    """
    counts = other.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))
    return df.join(counts, key, "inner")

"""Worked examples for the column functions and staff rules."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from haulframe.functions import dates, flags, numeric, people, text


def one(spark, column, schema="a string, b string", values=("", "")):
    return spark.createDataFrame([tuple(values)], schema).select(column).first()[0]


def test_route_and_key(spark):
    assert one(spark, text.route_segment("a", "b"), values=("Chennai", "Pune")) == "Chennai-Pune"
    assert one(spark, text.composite_key("a", "b"), "a string, b int", ("Truck", 500001)) == "Truck_500001"
    assert one(spark, text.route_segment("a", "b"), values=(None, "Pune")) is None


def test_full_name_skips_missing(spark):
    assert one(spark, text.full_name("a", "b"), values=(None, "Rao")) == "Rao"


def test_order_code(spark):
    assert one(spark, text.code_prefix("a"), values=("ORD100000", "")) == "ORD"
    assert one(spark, text.code_sequence("a"), values=("ORD100000", "")) == "100000"


def test_name_parts(spark):
    assert one(spark, text.first_word("a"), values=("anna maria lind", "")) == "anna"
    assert one(spark, text.last_word("a"), values=("anna maria lind", "")) == "lind"


def test_currency_both_ways(spark):
    assert one(spark, text.format_currency("a"), "a double, b int", (30695.8, 0)) == "₹30,695.80"
    assert one(spark, text.parse_currency("a"), values=("₹1,230,695.80", "")) == 1230695.8
    assert one(spark, text.parse_currency("a"), values=("₹none", "")) is None
    assert one(spark, text.parse_currency("a"), values=("30695.80", "")) == 30695.8
    assert one(spark, text.parse_currency("a"), values=("₹" + "0" * 2000 + "-1".replace("-", "") + ".5", "")) == 1.5


AMOUNTS = {
    "Rs. 500": 500.0, "Rs.1,000.50": 1000.5, "(30.00)": -30.0, "₹(1,200)": None, "(₹1,200)": -1200.0, "1e3": 1000.0, "1.5E-2 EUR": 0.015,
    "-5": -5.0, "₹-5": -5.0, "-₹5": -5.0, "5-": -5.0, "+7": 7.0, "\u22123": -3.0, "--5": None, "(-5)": None, "(5": None, "5)": None,
    "1,00,000.50": 100000.5, "1,2": None, "1,234,56": None, "12,34,567": 1234567.0, "1234,567": None, "1,2345": None, "1 234 567.5": 1234567.5,
    "1'000": 1000.0, ".5": 0.5, "5.": 5.0, "USD 3 net": 3.0, "3 4": None, "1.2.3": None, "": None, "  ": None, "kg": None, "5\x01": None, " US $ 9 ": 9.0,
    "1.234,56 €": None, "\u00a012\u00a0€": 12.0,
}
COMMA_AMOUNTS = {"1.234,56 €": 1234.56, "€ 1.234.567": 1234567.0, "12,5": 12.5, "(0,5)": -0.5, "1,234.56": None, "1 000,25-": -1000.25}


@pytest.mark.parametrize("decimal, cases", [(".", AMOUNTS), (",", COMMA_AMOUNTS)])
def test_amounts(spark, decimal, cases):
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = {r.t: r.v for r in df.select("t", text.parse_currency("t", decimal).alias("v")).collect()}
    assert got == cases | {None: None}


def test_amounts_of_long_texts(spark):
    df = spark.createDataFrame([(t * 200_000,) for t in (" ", "a ", "1,", "Rs. ", "-", "1", "1 ")], "t string")
    got = [r.v for r in df.select(text.parse_currency("t").alias("v")).collect()]
    assert got[:5] == [None] * 5 and got[5] == float("inf") and got[6] is None


def test_averages_are_not_rounded(spark):
    values = [0.125, 10.001, None, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert df.agg(numeric.money_sum("a"), numeric.money_avg("a")).first()[:] == (10.13, 5.063)


def test_partial_sums_are_those_of_decimals(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(3), round(rng.choice([1, -1]) * rng.random() * 10 ** rng.randrange(9), rng.randrange(7))) for _ in range(3000)]
    rows += [(0, -0.000001), (1, 999999999999.5), (2, -0.5), (2, 1e-9), (2, -1e-20)]
    df = spark.createDataFrame(rows, "k int, v double")
    per_key = df.groupBy("k", F.pmod(F.hash("v"), F.lit(5))).agg(*numeric.partial_sums("s", "v"))
    got = {r.k: r.t for r in per_key.groupBy("k").agg(*numeric.merged_sums("s")).select("k", numeric.total_of("s").alias("t")).collect()}
    want = {r.k: r.t for r in df.groupBy("k").agg(F.sum(numeric.exact("v")).alias("t")).collect()}
    assert got == want
    assert df.where("false").agg(numeric.money_sum("v"), numeric.money_avg("v")).first()[:] == (None, None)
    decimals = df.where("k = 0").select(numeric.exact("v").alias("v"))
    assert decimals.agg(numeric.exact_sum("v")).first()[0] == want[0]


def test_amounts_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="amount of 1000000000000 or more"):
        spark.createDataFrame([(1e12,)], "v double").agg(numeric.money_sum("v")).collect()


def test_case_refuses_numbers(spark):
    df = spark.createDataFrame([("Ab", 1.5)], "a string, n double")
    assert text.standard_case(df, lower=("a",)).first().a == "ab"
    with pytest.raises(TypeError):
        text.standard_case(df, lower=("n",))


def test_number_tests(spark):
    df = spark.createDataFrame([("12",), ("1a",), ("",), (None,), ("-1",)], "a string")
    rows = [tuple(r) for r in df.select(text.has_non_digit("a"), text.is_whole_number("a")).collect()]
    assert rows == [(False, True), (True, False), (False, False), (None, None), (True, False)]


@pytest.mark.parametrize(
    "given", ["23-04-24", "23-04-2024", "2024/04/23", "2024-04-23"]
)
def test_date_layouts(spark, given):
    assert one(spark, dates.parse_date("a"), values=(given, "")) == datetime.date(2024, 4, 23)


def test_date_misfit_and_century(spark):
    assert one(spark, dates.parse_date("a"), values=("April", "")) is None
    assert one(spark, dates.parse_date("a", latest="2025-12-31"), values=("03-10-98", "")) == datetime.date(1998, 10, 3)


@pytest.mark.parametrize(
    "given, want",
    [
        ("2030-05-01", datetime.date(2030, 5, 1)),
        ("30-05-95", datetime.date(1995, 5, 30)),
        ("31-12-25", datetime.date(2025, 12, 31)),
        ("29-02-00", datetime.date(2000, 2, 29)),
        ("29-02-30", None),
        ("29-02-01", None),
    ],
)
def test_only_two_digit_years_are_rolled(spark, given, want):
    assert one(spark, dates.parse_date("a", latest="2025-12-31"), values=(given, "")) == want


def test_impossible_leap_day_of_the_other_century(spark):
    assert one(spark, dates.parse_date("a", latest="1999-12-31"), values=("29-02-00", "")) is None


def test_date_parts_and_weekend(spark):
    df = spark.createDataFrame([("2024-04-23",), ("2024-04-27",), ("2024-04-28",), (None,)], "d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    rows = df.select(F.year("d"), F.month("d"), dates.is_weekend("d"), dates.days_since("d", "2024-05-01")).collect()
    assert [tuple(r) for r in rows] == [(2024, 4, False, 8), (2024, 4, True, 4), (2024, 4, True, 3), (None, None, False, None)]


def test_flags(spark):
    df = spark.createDataFrame(
        [("IN_TRANSIT", 50000.0), ("delivered", 50000.01), ("delayed", 1.0), (None, None)], "s string, c double"
    )
    rows = df.select(flags.is_expedited("s"), flags.is_high_value("c")).collect()
    assert [tuple(r) for r in rows] == [(True, False), (True, True), (False, False), (False, False)]


def test_ratio_and_tax(spark):
    df = spark.createDataFrame([(100.0, 8.0), (100.0, 0.0), (100.0, None)], "c double, w double")
    assert [r[0] for r in df.select(numeric.cost_per_kg("c", "w")).collect()] == [12.5, None, None]
    assert one(spark, numeric.tax_amount("a"), "a double, b int", (0.25, 0)) == 0.05  # 0.045 rounds up


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(0.2,)] * 1000 + [(None,)], "a double")
    assert df.agg(numeric.money_sum("a")).first()[0] == 300.0
    assert df.agg(numeric.money_avg("a")).first()[0] == 0.15
    small = spark.createDataFrame([(0.004,)] * 1000, "a double")
    assert small.agg(numeric.money_sum("a")).first()[0] == 4.0
    for value, want in ((0.125, 0.13), (1.005, 1.01)):
        assert spark.createDataFrame([(value,)], "a double").agg(numeric.money_sum("a")).first()[0] == want


STAFF = [
    ("driver", 51, 3000.0),
    ("driver", 29, 500.0),
    ("driver", 50, 0.0),
    ("driver", 30, 0.0),
    ("driver", None, 0.0),
    ("clerk", 60, 0.0),
    (None, 60, 0.0),
]


def test_bonus_both_forms(spark):
    df = spark.createDataFrame(STAFF, "role string, age int, want double")
    rows = df.select("want", people.bonus().alias("a"), people.bonus_arrow("role", "age").alias("b")).collect()
    assert all(r.a == r.want and r.b == r.want for r in rows)


def test_mask_both_forms(spark):
    names = ["Kristina", "Al", "Bob", "", None]
    want = ["Kr****a", "Al", "Bo****b", "", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(people.mask_name("n")).collect()] == want
    assert [r[0] for r in df.select(people.mask_name_arrow("n")).collect()] == want


def test_udfs_from_sql(spark):
    people.register(spark)
    assert spark.sql("SELECT mask_name('Kristina'), projected_bonus('driver', 51)").first()[:] == ("Kr****a", 3000.0)

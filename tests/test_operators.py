"""Properties of the steps, and brute-force checks of those that are shaped for large groups."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from haulframe.functions.numeric import exact
from haulframe.operators import aggregates, joins, ordering, params, quality, sets, shaping, windows

ROSTER = [
    ("1", "Ana", None, "31", "Driver", "pune", "Truck"),
    ("2", None, None, "ten", "Clerk", "pune", "bike"),
    (None, "Raj", "Rao", "44", "Driver", None, None),
    ("X4", "Eva", "Lee", "", None, "goa", "TRUCK"),
    ("5", "Ida", "Kim", None, "Driver", "goa", "Van"),
]
COLUMNS = "shipment_id string, first_name string, last_name string, age string, role string, hub_location string, vehicle_type string"


@pytest.fixture(scope="module")
def roster(spark):
    return spark.createDataFrame(ROSTER, COLUMNS)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# Quality


def test_require(roster):
    assert [r.shipment_id for r in quality.require(roster, "shipment_id", "role").collect()] == ["1", "2", "5"]
    assert [r.shipment_id for r in quality.require_one_of(roster, "first_name", "last_name").collect()] == ["1", None, "X4", "5"]


def test_no_null_left_after_full_drop(roster):
    kept = quality.require(roster, *roster.columns)
    assert kept.where("age IS NULL").count() == 0


def test_scrub(roster):
    rows = {r.shipment_id: (r.age, r.vehicle_type) for r in quality.scrub_staff(roster).collect()}
    assert rows == {
        "1": ("31", "LMV"),
        "2": ("-1", "TwoWheeler"),
        None: ("44", "UNKNOWN"),
        "X4": ("-1", "LMV"),
        "5": ("-1", "Van"),
    }


def test_scrub_twice_changes_nothing(roster):
    once = quality.scrub_staff(roster)
    assert bag(quality.scrub_staff(once)) == bag(once)


def test_fill_refuses_other_types(spark):
    df = spark.createDataFrame([(None,)], "n int")
    with pytest.raises(TypeError):
        quality.fill_text(df, "-1", "n")


def test_width_counts_respect_quotes(spark):
    lines = spark.createDataFrame([("a,b,c",), ("a,b",), ('a,"b,c",d',), ("a,b,c,d",), ("",)], "value string")
    assert quality.count_by_width(lines, 3).first()[:] == (1, 2, 1)  # the reader skips the empty line


def test_width_counts_as_the_reader_does(spark):
    lines = ['1,"say \\",x",3', '1,"a ""b"" c,d",3', '5" pipe,x,3', '"open,2,3', ",,"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r[0] for r in df.select(quality.field_count("value")).collect()]
    assert got[0] == 3 and got[2] == 3 and got[4] == 3
    doubled = [r[0] for r in df.select(quality.field_count("value", escape='"')).collect()]
    assert doubled[1] == 3


def test_widths_agree_with_the_reader(spark, folder):
    rng = random.Random(8)
    lines = ["".join(rng.choice('a,,"\\ ') for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    lines += ['a, "b,c",d', '1,"open,2', "   ", ",", '"a","b"x,c', "a,b,", 'a,"",c', '"', 'a,"b\\']
    numbered = spark.createDataFrame([(x,) for x in dict.fromkeys(lines)], "value string")
    path = folder("widths")
    numbered.coalesce(1).write.text(path)
    got = {r.value: r.n for r in numbered.select("value", quality.field_count("value", most=6).alias("n")).collect()}
    read = dict.fromkeys(got)
    for width in range(1, 13):
        schema = ", ".join(f"c{i} string" for i in range(width)) + ", _corrupt_record string"
        # a record is kept as corrupt unless it has as many fields as the schema
        odd = {r["_corrupt_record"] for r in spark.read.schema(schema).csv(path).collect()}
        for line in read:
            if read[line] is None and line.strip() and line not in odd:
                read[line] = width
    assert got == {line: None if n is None else min(n, 7) for line, n in read.items()}
    assert got['a, "b,c",d'] == 4 and got['1,"open,2'] == 2 and got["   "] is None


def test_dedup_is_repeatable(spark):
    rows = [(k % 5, v) for k, v in itertools.product(range(10), range(30))]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v int").repartition(6)
    first = quality.dedup_by_key(df, ["k"], [F.desc("v")])
    assert bag(first) == Counter({(k, 29): 1 for k in range(5)})


def test_common_keys_count_repeats(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "z")], "k string, v string")
    b = spark.createDataFrame([("1",), ("1",), ("3",), (None,)], "k string")
    assert [tuple(r) for r in quality.matches_in(a, b, "k").collect()] == [("1", "x", 2)]


# Joins


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame([(i, f"hub{i % 3}") for i in range(12)] + [(None, "hub0")], "id int, hub string")


@pytest.fixture(scope="module")
def ships(spark):
    rows = [(i % 7 + 8, 10.0 * i) for i in range(40)] + [(None, 1.0)]
    return spark.createDataFrame(rows, "id int, cost double")


def test_semi_and_anti_split_the_left(staff, ships):
    kept, lost = joins.existing(staff, ships, "id"), joins.missing(staff, ships, "id")
    assert bag(kept) + bag(lost) == bag(staff)
    assert {r.id for r in kept.collect()} == {8, 9, 10, 11}


def test_reconcile_equals_full_join(staff, ships):
    columns = ["id", "hub", "cost"]
    want = bag(staff.join(ships, "id", "full").select(columns))
    assert bag(joins.reconcile(staff, ships, "id").select(columns)) == want


def test_reconcile_with_repeats_and_nulls_on_both_sides(spark):
    left = spark.createDataFrame([(i % 7 if i % 3 else 5, i) for i in range(60)] + [(None, -1), (99, -2)], "k int, a int")
    right = spark.createDataFrame([(i % 5, i) for i in range(40)] + [(None, -3), (77, -4)], "k int, b int")
    assert bag(joins.reconcile(left, right, "k").select("k", "a", "b")) == bag(left.join(right, "k", "full").select("k", "a", "b"))


def test_hot_unmatched_keys_of_a_full_join_are_spread(spark):
    """A third of the left rows on one key without a match: no task holds more than a part of them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
        right = spark.range(600).select(F.col("id").alias("k"), F.col("id").alias("b"))
        out = joins.reconcile(left, right, "k").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in out.where("k = -7").groupBy("task").count().collect()]
        assert sum(sizes) == 10_000 and max(sizes) < 4_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_full_is_inner_and_both_sides(staff, ships):
    full = joins.reconcile(staff, ships, "id").count()
    inner = staff.join(ships, "id").count()
    assert full == inner + joins.missing(staff, ships, "id").count() + joins.missing(ships, staff, "id").count()


def test_peers_against_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(40), f"h{rng.randrange(4)}") for _ in range(120)] + [(99, "alone"), (None, "h1"), (7, None)]
    got = {(r.m, r.h): (r.peers, r.first_peer, r.last_peer) for r in joins.peers_per_member(
        spark.createDataFrame(rows, "m int, h string"), "h", "m").collect()}
    want = {}
    for m, h in set(rows):
        others = [o for o, g in rows if None not in (m, h, o, g) and g == h and o != m]
        if others:
            want[m, h] = (len(others), min(others), max(others))
    assert got == want


def test_each_of_top_is_a_product(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "d int")
    report = spark.createDataFrame([(i, i * 1.5) for i in range(20)], "o int, c double")
    got = bag(joins.with_each_of_top(df, report, [F.desc("c"), F.asc("o")], 3))
    assert got == Counter({(d, o, o * 1.5): 1 for d in range(5) for o in (17, 18, 19)})


def test_each_of_top_with_short_report(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "d int")
    report = spark.createDataFrame([(1, 1.0)], "o int, c double")
    assert joins.with_each_of_top(df, report, [F.desc("c")], 3).count() == 5


def test_totals_across_equal_the_join(staff, ships):
    right = ships.where("id IS NOT NULL").withColumn("hub", F.concat(F.lit("hub"), (F.col("id") % 4).cast("string")))
    got = bag(joins.totals_across(staff, right, "hub", "cost", "s", "r").select("hub", "pairs", "pair_amount"))
    joined = staff.join(right.drop("id"), "hub").groupBy("hub").agg(F.count("*"), F.sum("cost"))
    assert got == bag(joined)


@pytest.mark.parametrize("null_safe, how", [(False, "inner"), (True, "inner"), (False, "left")])
def test_lookup_is_a_join(spark, staff, null_safe, how):
    small = spark.createDataFrame([(f"hub{i}", i) for i in range(2)] + [(None, 9)], "hub string, n int")
    rows = staff.unionByName(spark.createDataFrame([(77, None)], "id int, hub string"))
    got = bag(joins.lookup(rows, small, ["hub"], how, null_safe).select("id", "hub", "n"))
    want = bag(rows.where("hub IS NOT NULL" if how == "inner" else "true").join(small, "hub", how).select("id", "hub", "n"))
    assert got == want + (Counter({(77, None, 9): 1}) if null_safe else Counter())


# Aggregates


@pytest.fixture(scope="module")
def costs(spark):
    rows = [("a" if i % 3 else None, f"v{i % 2}", i * 1.01) for i in range(1, 50)]
    return spark.createDataFrame(rows, "hub string, kind string, cost double")


@pytest.mark.parametrize("cube, levels", [(False, {0, 1, 3}), (True, {0, 1, 2, 3})])
def test_subtotals(costs, cube, levels):
    base = costs.select("hub", "kind", exact("cost").alias("c"), F.lit(1).alias("n"))
    rows = aggregates.subtotals(base, ["hub", "kind"], "c", "n", cube).collect()
    assert {r.level for r in rows} == levels
    total = round(sum(i * 1.01 for i in range(1, 50)), 2)
    assert [r.sumamt for r in rows if r.level == 3] == [total]
    for level in levels:
        assert round(sum(r.sumamt for r in rows if r.level == level), 2) == total
    # A missing hub and a subtotal are different rows.
    assert sum(1 for r in rows if r.hub is None and r.level == 0) == 2


def test_profile(costs):
    rows = {r.column_name: r for r in aggregates.profile(costs, ["cost", "hub"]).collect()}
    assert rows["cost"]["count"] == 49 and rows["hub"]["count"] == 33
    assert rows["hub"]["mean"] is None and rows["hub"]["min"] == "a"
    assert rows["cost"]["mean"] == round(sum(i * 1.01 for i in range(1, 50)) / 49, 4)


def test_quantiles_are_exact(spark):
    rng = random.Random(17)
    rows = [
        (rng.choice([5.5, 5.5, rng.gauss(0, 1e6), None]), rng.randrange(3), 2**53 + 1, None, rng.choice(["b", "aa", "c"]))
        for _ in range(700)
    ]
    df = spark.createDataFrame(rows, "a double, b int, c bigint, d int, e string")
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = {r.column_name: r[1:] for r in aggregates.quantiles(df, list("abcde"), shares).collect()}
    for i, name in enumerate("abcde"):
        values = sorted(r[i] for r in rows if r[i] is not None)
        want = [values[max(1, math.ceil(q * len(values))) - 1] if values else None for q in shares]
        assert [None if v is None else type(w)(v) for v, w in zip(got[name], want)] == want


def test_quantiles_take_two_shuffles_of_the_values(spark, monkeypatch):
    """Whatever the number of columns: one that counts equal values, one that deals the counts by range."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, dealt = [], DataFrame.repartitionByRange
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda self, *a: seen.append(out := dealt(self, *a)) or out)
    df = spark.range(500).selectExpr("id AS a", "id % 7 AS b", "cast(id AS string) AS c", "cast(id AS double) AS d", "cast(id % 3 AS int) AS e")
    rows = {r.column_name: r[1:] for r in aggregates.quantiles(df, df.columns, (0.5, 1.0)).collect()}
    assert rows == {"a": ("249", "499"), "b": ("3", "6"), "c": (sorted(map(str, range(500)))[249], "99"), "d": ("249.0", "499.0"), "e": ("1", "2")}
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 1 and plan.count("Exchange") == 2


def test_averages_are_of_the_unrounded_total(spark):
    df = spark.createDataFrame([("a", "x", 0.004)] * 3 + [("b", "x", 0.125), ("b", "y", 10.001)], "k string, l string, v double")
    partial = df.groupBy("k", "l").agg(F.sum(F.col("v").cast("decimal(18,6)")).alias("s"), F.count("*").alias("n"))
    rows = {(r.k, r.l): r for r in aggregates.subtotals(partial, ["k", "l"], "s", "n").collect()}
    assert rows["a", None].avgamt == 0.004 and rows["a", None].sumamt == 0.01
    assert rows["b", None].avgamt == 5.063 and rows[None, None].avgamt == 10.138 / 5


def test_quantiles_rank_nan_last(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = aggregates.quantiles(df, ["x"], (0.2, 0.4, 0.8, 1.0)).first()
    assert row[1:] == ("-Infinity", "1.0", "Infinity", "NaN")


def test_profile_with_quartiles(spark):
    df = spark.range(1, 101).select(F.col("id").alias("x"), F.chr("id").alias("t"), F.lit(None).cast("int").alias("none"))
    rows = {r.column_name: r for r in aggregates.profile_with_quartiles(df, df.columns).collect()}
    row = rows["x"]
    assert (row["count"], row.p25, row.p50, row.p75, row.max) == (100, "25", "50", "75", "100")
    assert rows["t"].p50 == chr(50) and rows["none"]["count"] == 0 and rows["none"].p50 is None


# Sets


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "z")], "k int, v string")
    assert bag(sets.in_both(a, b)) == bag(a.intersect(b)) == Counter({(1, "x"): 1, (2, None): 1})
    assert bag(sets.only_in_first(a, b)) == bag(a.subtract(b)) == Counter({(3, "y"): 1})
    assert sets.in_both(a, b).count() + sets.only_in_first(a, b).count() == a.distinct().count()


def test_align_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2, "z")], "k int, v string")
    assert bag(sets.align(a, b)) == Counter({(1, None): 1, (2, "z"): 1})


# Shaping, ordering, parameters


def test_names_are_cleaned(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a b` int, `c%` int, `d/e` int")
    assert shaping.sanitize_names(df).columns == ["a_b", "cPercent", "d_e"]


def test_name_collision_is_refused(spark):
    with pytest.raises(ValueError):
        shaping.sanitize_names(spark.createDataFrame([(1, 2)], "`a b` int, `A/B` int"))


def test_sorts_are_in_order(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v")).repartition(5)
    rows = [(r.v, r.id) for r in ordering.sort_total(df, [F.desc("v")], "id").collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1]))
    top = [(r.v, r.id) for r in ordering.top_k(df, [F.desc("v")], "id", 10).collect()]
    assert top == rows[:10]


def test_sample_share_and_stability(spark):
    df = spark.range(20_000)
    picked = {r.id for r in ordering.sample_by_key(df, "id", 0.1).collect()}
    assert 1700 < len(picked) < 2300
    assert picked == {r.id for r in ordering.sample_by_key(df.repartition(9), "id", 0.1).collect()}
    assert ordering.sample_by_key(df, "id", 0.0).count() == 0


def test_choices(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    assert bag(params.choose_many(df, "v", "a, c", ["a", "b", "c"])) == Counter({("a",): 1, ("c",): 1})
    assert bag(params.choose_one(df, "v", ["b", "c"])) == Counter({("b",): 1})
    with pytest.raises(ValueError):
        params.choose_many(df, "v", "a,z", ["a", "b"])
    with pytest.raises(ValueError):
        params.choose_one(df, "v", ["a"], "a' OR 1=1")


# Windows


def test_top_values_with_heavy_ties(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["a", "a", "b", None]), rng.choice([5.0, 5.0, 4.0, 3.0, 2.0, None])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, g string, v double").repartition(7)
    want = Counter()
    for group in {r[1] for r in rows}:
        values = sorted({r[2] for r in rows if r[1] == group}, key=lambda v: (v is None, -(v or 0)))
        rank = {v: i + 1 for i, v in enumerate(values)}
        want.update((i, g, v, rank[v]) for i, g, v in rows if g == group and rank[v] <= 3)
    assert bag(windows.top_values(df, ["g"], "v", 3)) == want


def neighbours_by_hand(rows):
    want = Counter()
    for key in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(seq):
            before = seq[i - 1][3] if i else None
            after = seq[i + 1][3] if i + 1 < len(seq) else None
            want[(*r, before, after)] += 1
    return want


def test_neighbours_with_one_key_holding_a_third(spark):
    rng = random.Random(13)
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 28)]
    rows = [(1, rng.choice(days), i, rng.choice([None, 1.0, 2.0, 3.0])) for i in range(400)]
    rows += [(None, rng.choice(days), i, float(i)) for i in range(400, 550)]
    rows += [(rng.randrange(2, 90), rng.choice(days), i, float(i)) for i in range(550, 1200)]
    rows += [(500, "2024-05-05", i, float(i)) for i in range(1200, 1900)]
    rows += [(k, d, k, 1.0) for k in range(1000, 1300) for d in days[:2]]
    df = spark.createDataFrame(rows, "k int, d string, id int, v double").withColumn("d", F.col("d").cast("date"))
    got = windows.neighbours(df.repartition(5), ["k"], "d", "id", "v", previous="p", following="f")
    as_text = got.select("k", F.col("d").cast("string"), "id", "v", "p", "f")
    assert bag(as_text) == neighbours_by_hand(rows)


def test_neighbours_in_a_skipped_hour(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(1, f"2024-03-10 {h:02d}:{m:02d}:00", h * 60 + m, float(h * 60 + m)) for h in range(4) for m in range(0, 60, 5)]
        df = spark.createDataFrame(rows, "k int, d string, id int, v double")
        df = df.withColumn("d", F.col("d").cast("timestamp_ntz"))
        got = windows.neighbours(df, ["k"], "d", "id", "v", previous="p").orderBy("id").collect()
        assert [r.p for r in got] == [None, *[r[3] for r in rows[:-1]]]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_one_neighbour_column(spark):
    rows = [(1, "2024-01-01", 1, 5.0), (1, "2024-01-02", 2, 7.0)]
    df = spark.createDataFrame(rows, "k int, d string, id int, v double").withColumn("d", F.col("d").cast("date"))
    got = windows.neighbours(df, ["k"], "d", "id", "v", following="f")
    assert [(r.id, r.f) for r in got.orderBy("id").collect()] == [(1, 7.0), (2, None)]
    assert got.columns == ["k", "d", "id", "v", "f"]


def test_change_pattern(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, 4.0), (5.0, 6.0), (5.0, 5.0)], "c double, p double")
    words = [r[0] for r in df.select(windows.change_pattern("c", "p")).collect()]
    assert words == ["first transaction", "increase", "decrease", "no change"]

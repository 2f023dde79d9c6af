"""Plans that must stay as they are: what is pushed down, what is moved, what stays out of Python."""

import pytest
from pyspark.sql import functions as F

from haulframe.plans import QUERIES
from haulframe.operators import windows

PARTS_IN_ORDER = {"win_lead", "win_lag", "win_change_pattern", "agg_summary"}
PYTHON_QUERIES = {"udf_bonus_pandas", "udf_mask_pandas"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Plans without automatic broadcast of tables, as they are when every table is large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        yield {name: plan_of(q(spark, sf_dir)) for name, q in QUERIES.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_cartesian_products(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_python_only_where_named(plans):
    for name, plan in plans.items():
        assert "BatchEvalPython" not in plan, name
        assert ("ArrowEvalPython" in plan) == (name in PYTHON_QUERIES), name


def test_no_single_partition_sort_or_window(plans):
    """One task may only see a global aggregate, or the rows of a top-k report."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                above = lines[i - 1]
                fits = "Aggregate" in above or "TakeOrderedAndProject" in plan
                # neighbours: the first and last rows of the parts, one line per part
                assert fits or name in PARTS_IN_ORDER, (name, above)


def test_broadcasts_are_bounded(plans):
    """With automatic broadcast off, only reports of k rows are broadcast."""
    allowed = {"join_cross", "pipe_delay_dashboard"}
    for name, plan in plans.items():
        if "BroadcastExchange" in plan:
            assert name in allowed and "TakeOrderedAndProject" in plan, name


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("flt_in_list", "In(o_orderpriority, [1-URGENT,2-HIGH])"),
        ("param_choice_filter", "EqualTo(event_type,click)"),
        ("src_parquet", "GreaterThan(l_quantity,25.0)"),
    ],
)
def test_filters_reach_the_scan(plans, name, pushed):
    assert pushed in plans[name]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("agg_group_count_distinct", "struct<o_custkey:bigint,o_orderpriority:string>"),
        ("agg_count", "struct<>"),
        ("agg_distinct_count", "struct<l_orderkey:bigint,l_linenumber:int>"),
    ],
)
def test_only_needed_columns_are_read(plans, name, columns):
    assert f"ReadSchema: {columns}" in plans[name]


def test_top_n_is_cut_before_the_shuffle(plans):
    for name in ("win_topn_row_number", "top_drivers_per_hub", "dq_dedup_key", "pipe_silver_staff"):
        windowed = plans[name].count("+- Window [row_number()")
        assert windowed >= 1 and plans[name].count("WindowGroupLimit") == 2 * windowed, name


def test_set_operations_take_one_shuffle(plans):
    for name in ("set_intersect", "set_subtract"):
        assert "Join" not in plans[name].split("Union")[0], name


def test_lead_and_lag_share_one_window(plans):
    # one window over the rows, one over the ends of the parts
    assert plans["win_change_pattern"].count("+- Window [") == 2


def test_parts_of_hot_groups_are_even(spark):
    """No window sees more than its share of rows, though one key and day has a third of them."""
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).alias("k"), F.lit("2024-01-01").cast("date").alias("d"), "id"
    )
    out = windows.neighbours(df, ["k"], "d", "id", "id", previous="p", following="f").where("k = -1")
    assert out.where("p <> id - 1 OR f <> id + 1").count() == 0
    assert out.where("p IS NULL").count() == out.where("f IS NULL").count() == 1


def test_no_jobs_but_writes_at_build_time(spark, sf_dir):
    """Building a ranked or looked-up query reads nothing."""
    tracker = spark.sparkContext.statusTracker()
    for name in ("win_topn_dense_rank", "join_self_theta", "join_inner", "pipe_profile"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, sf_dir)
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 9, name  # schema of Parquet files, one small job each
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

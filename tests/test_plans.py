"""What the physical plans must look like for the queries to hold at a thousand times the data."""

import contextlib
import re

import pytest
from compare import difference, spark_rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyfold.catalog.queries import DATES, registered
from tallyfold.plans import report
from tallyfold.sources.star import star_facts

# They write files while they are built, so they have no plan before they run.
WRITING = {
    "scan_daily_averages", "csv_load_declared", "csv_load_inferred", "csv_load_table", "csv_write", "replace_table",
    "csv_load_rejects", "reconcile_load", "incremental_report", "stored_daily_averages", "sketched_product_counts",
    "verify_row_count", "write_report_tables", "cost_report", "filtered_cost_report",
}
LAZY = sorted(set(registered()) - WRITING)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return {name: plan_of(entry.queries()[name](spark, folder)) for name in LAZY}


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cartesian_product_no_expand(plans, name):
    for operator in ("ArrowEval", "BatchEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        # The grouping sets of the scorecards multiply rows that are one per product already.
        assert operator not in plans[name] or (name, operator) == ("scorecards", "Expand")


@pytest.mark.parametrize(
    "name", ["scorecard", "period_matrix", "cto_costs", "pillar_costs", "product_costs", "daily_average_table", "trend_series", "span_costs", "scorecards"]
)
def test_facts_are_scanned_once(plans, name):
    assert plans[name].count("lineitem.parquet]") == 1


def test_grains_of_the_report_are_small_and_scan_the_facts_once(spark, folder):
    facts = star_facts(spark, folder)
    days, products = report.costs_per_day(facts, DATES), report.costs_per_product(facts, DATES)
    for grain in (days, products):
        assert plan_of(grain).count("lineitem.parquet]") == 1
    # Copies of the facts add nothing to a grain.
    twice = facts.unionByName(facts)
    assert report.costs_per_day(twice, DATES).count() == days.count() <= days.select("date").distinct().count() * 2 * 6
    assert report.costs_per_product(twice, DATES).count() == products.count()


def test_dates_and_columns_reach_the_scan(plans):
    scan = re.search(r"FileScan parquet \[l_orderkey.*", plans["ytd_costs"]).group()
    assert "GreaterThanOrEqual(l_shipdate,1998-02-01T00:00)" in scan
    assert "LessThan(l_shipdate,1998-08-04T00:00)" in scan
    assert "l_partkey" not in scan and "l_quantity" not in scan


def test_only_needed_dimensions_are_joined(plans):
    assert plans["ytd_costs"].count("FileScan") == 2
    assert plans["distinct_product_count"].count("FileScan") == 2
    assert plans["month_bounds"].count("FileScan") == 1


def test_top_n_does_not_sort_everything(plans):
    for name in ("cto_costs", "pillar_costs", "product_costs", "top_rows_then_rollup"):
        assert "TakeOrderedAndProject" in plans[name]


def test_sums_are_taken_before_the_shuffle(plans):
    for name in ("ytd_costs", "cto_costs", "product_costs", "daily_costs"):
        assert "partial_sum" in plans[name]


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def configured(spark, **_settings):
    settings = {**NO_BROADCAST, **_settings}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def skew_settings(size):
    return {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
    }


@pytest.mark.parametrize("name", ["product_costs", "daily_average_table", "filter_combination_exists", "env_mean_baseline"])
def test_results_do_not_depend_on_broadcasts(spark, folder, name):
    expected = spark_rows(entry.queries()[name](spark, folder))
    with configured(spark, **skew_settings("2k")):
        found = spark_rows(entry.queries()[name](spark, folder))
    assert difference(found, expected) is None


def test_a_hot_key_is_split_in_the_join(spark, tmp_path):
    """A third of all lines on one part: the join splits the partition of that part."""
    source = "/root/testdata/sf0.01"
    for table in ("part", "orders", "supplier", "nation", "region"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{source}/{table}.parquet")
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    hot = lines.withColumn("l_partkey", F.expr("if(l_linenumber <= 2, 17L, l_partkey)"))
    hot.repartition(16).write.parquet(f"{tmp_path}/lineitem.parquet")
    share = hot.filter("l_partkey = 17").count() / lines.count()
    assert share > 0.25
    expected = spark_rows(entry.queries()["product_display_id"](spark, str(tmp_path)))
    with configured(spark, **skew_settings("20k")):
        facts = star_facts(spark, str(tmp_path), "date", "tr_product", "cost")
        totals = facts.groupBy("tr_product").agg(F.sum("cost").alias("cost"))
        found = spark_rows(totals)
        assert "skew=true" in plan_of(totals)
        assert difference(spark_rows(entry.queries()["product_display_id"](spark, str(tmp_path))), expected) is None
    assert difference(found, spark_rows(star_facts(spark, str(tmp_path), "date", "tr_product", "cost")
                                        .groupBy("tr_product").agg(F.sum("cost").alias("cost")))) is None

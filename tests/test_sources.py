from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyfold.operators import breakdowns, daily, periods, trend
from tallyfold.operators.filters import CostFilter
from tallyfold.plans import report
from tallyfold.plans.dates import ReportDates
from tallyfold.schemas import (
    COST_FACTS,
    COST_FACTS_FLOAT,
    DAILY_AVERAGE_KEYS,
    daily_average_fields,
    struct_from_json,
    struct_of,
)
from tallyfold.sources import delimited, named, shared, tables

DATES = ReportDates(date(2025, 5, 6))
YEAR = DATES.fiscal_year.range


@pytest.fixture
def table(facts):
    labels = ("PROD", "NON-PROD", "PROD-DR", None)
    return facts(
        *[
            (f"202{4 + i % 2}-0{2 + i % 4}-0{1 + i % 9}", labels[i % 4], i * 3.17, f"org{i % 3}", f"pil{i % 5}", f"P{i % 7}")
            for i in range(120)
        ],
        ("2025-05-03", "PROD", 11, None, None, None),
        ("2025-05-02", "NON-PROD", 12),
        ("2025-04-20", "PROD", 13),
    )


def test_declared_types():
    schema = struct_from_json(
        [{"name": "a", "type": "DATE"}, {"name": "b", "type": "INTEGER"}, {"name": "c", "type": "FLOAT"},
         {"name": "d", "type": "GEOGRAPHY"}, {"name": "e"}]
    )
    assert schema.simpleString() == "struct<a:date,b:bigint,c:double,d:string,e:string>"
    assert all(field.nullable for field in schema.fields)


def test_daily_average_schema():
    fields = daily_average_fields(DATES.average_columns.values())
    assert [name for name, _ in fields] == [
        *(name for name, _ in DAILY_AVERAGE_KEYS), *DATES.average_columns.values(), "daily_cost"
    ]


def test_values_that_do_not_fit_become_null(spark):
    raw = spark.createDataFrame([("2025-03-01", "1.5"), ("soon", "much")], "date string, cost string")
    found = rows_of(tables.conform_to_schema(raw, COST_FACTS_FLOAT).select("date", "cost", "cloud"))
    assert found == [(None, None, None), (date(2025, 3, 1), 1.5, None)] or found == [
        (date(2025, 3, 1), 1.5, None),
        (None, None, None),
    ]


@pytest.mark.parametrize("header", [True, False])
def test_csv_round_trip_keeps_quotes_spaces_commas_and_nulls(spark, tmp_path, facts, header):
    table = facts(
        ("2025-03-01", "PROD", "1.2345", 'a "quoted", one', " padded ", "", "x,y"), ("2025-03-02", None, None, None)
    )
    delimited.csv_write(table, f"{tmp_path}/t", header)
    assert rows_of(delimited.csv_load_declared(spark, f"{tmp_path}/t", COST_FACTS, header)) == rows_of(table)


def test_load_uses_the_declared_schema(spark, tmp_path, table):
    delimited.csv_write(table, f"{tmp_path}/in", header=False)
    loaded = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, f"{tmp_path}/out")
    assert loaded.schema == COST_FACTS
    assert rows_of(loaded) == rows_of(table)
    check = tables.verify_row_count(loaded, table).first()
    assert (check.loaded_rows, check.expected_rows, check.row_counts_match) == (123, 123, True)


def test_load_falls_back_to_detected_types(spark, tmp_path, facts):
    odd = facts(("2025-03-01", "PROD", 1)).selectExpr("* except (cost)", "'n/a' as cost")
    delimited.csv_write(odd, f"{tmp_path}/in", header=False)
    loaded = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, f"{tmp_path}/out")
    assert loaded.columns == COST_FACTS.names
    assert (loaded.first().cost, loaded.first().date) == ("n/a", date(2025, 3, 1))


def test_fallback_keeps_declared_texts_and_refuses_another_width(spark, tmp_path, facts):
    odd = facts(("2025-03-01", "PROD", 1)).selectExpr("* except (cost)", "'n/a' as cost").withColumn("tr_product_id", F.lit("0012"))
    delimited.csv_write(odd.select(COST_FACTS.names), f"{tmp_path}/in", header=False)
    loaded = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, f"{tmp_path}/out")
    assert loaded.first().tr_product_id == "0012"
    delimited.csv_write(odd.withColumn("more", F.lit(1)), f"{tmp_path}/wide", header=False)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        delimited.csv_load_table(spark, f"{tmp_path}/wide", COST_FACTS, f"{tmp_path}/out")
    with pytest.raises(ValueError, match="columns"):
        delimited.csv_load_inferred(spark, f"{tmp_path}/wide", COST_FACTS.names)


@pytest.mark.parametrize("partition", [None, "date", "month"])
def test_replacing_a_table_leaves_only_the_new_rows(spark, tmp_path, table, facts, partition):
    path = f"{tmp_path}/t"
    tables.replace_table(facts(("1999-01-01", "PROD", 1)), path, partition)
    tables.replace_table(table, path, partition)
    assert rows_of(tables.scan_cost_facts(spark, path)) == rows_of(table)


def test_replacing_a_catalog_table(spark, tmp_path, table):
    for _ in range(2):
        found = tables.replace_table(table, f"{tmp_path}/t", table="replaced_facts")
    assert rows_of(tables.read_table(spark, "replaced_facts", COST_FACTS)) == rows_of(table)
    assert found.count() == table.count()


@pytest.mark.parametrize("partition", ["date", "month"])
def test_date_ranges_prune_partitions(spark, tmp_path, table, partition):
    path = f"{tmp_path}/t"
    tables.replace_table(table, path, partition)
    found = tables.scan_cost_facts(spark, path, spans=[YEAR])
    assert rows_of(found) == rows_of(table.filter(YEAR.contains()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({partition}" in plan


def test_union_fills_missing_columns_and_casts(spark, facts):
    base = facts(("2025-03-01", "PROD", 1))
    other = facts(("2025-03-02", "DEV", 2)).drop("tr_subpillar_name").selectExpr("* except (cost)", "'2' as cost")
    found = rows_of(tables.union_sources([base, other]).select("date", "tr_subpillar_name", "cost"))
    assert [(r[1], float(r[2])) for r in found] == [("Core", 1.0), (None, 2.0)]


def test_shared_root_is_the_checkpoint_folder(spark):
    before = shared.shared_root(spark)
    assert shared.shared_root(spark) == before
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert before == configured.rstrip("/")
    assert shared.stored(spark.range(3), "n").count() == 3
    assert shared.new_folder(spark, "n").startswith(f"{before}/n-")


class _Session:
    """Stands in for a session with given settings."""

    def __init__(self, master, setting=None):
        self.conf = self
        self.sparkContext = self
        self.master, self.setting = master, setting

    def get(self, key, default=None):
        return self.setting if key == "spark.checkpoint.dir" and self.setting else default

    def getCheckpointDir(self):
        return None


def test_a_cluster_must_name_its_shared_folder():
    assert shared.shared_root(_Session("yarn", "hdfs://h/shared/")) == "hdfs://h/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_root(_Session("yarn"))
    assert shared.shared_root(_Session("local[2]")) == shared.shared_root(_Session("local[2]"))


NAMED = {
    "ytd_costs": lambda t, c: periods.ytd_costs(t, DATES, chosen=c),
    "fy_total_costs": lambda t, c: periods.fy_total_costs(t, DATES, chosen=c),
    "prior_fy_costs": lambda t, c: periods.prior_fy_costs(t, DATES, c),
    "cto_costs": lambda t, c: breakdowns.cto_costs(t, DATES, 10, c),
    "pillar_costs": lambda t, c: breakdowns.pillar_costs(t, DATES, 10, c),
    "product_costs": lambda t, c: breakdowns.product_costs(t, DATES, 10, c),
}


@pytest.mark.parametrize("name", sorted(NAMED))
@pytest.mark.parametrize("chosen", [CostFilter(), CostFilter(cto="org1"), CostFilter("org1", "pil2", "P4")])
def test_named_query_equals_operator(spark, table, name, chosen):
    table.createOrReplaceTempView("named_facts")
    found = named.named_query(
        spark, name, "named_facts",
        fy_start=YEAR.start, fy_end=YEAR.end, cutoff=DATES.cutoff, top_n=10,
        prior_fy_start=DATES.prior_year.start, prior_fy_end=DATES.prior_year.end,
        prior_ytd_end=DATES.prior_ytd.end, cto=chosen.cto, pillar=chosen.pillar, product=chosen.product,
    )
    expected = NAMED[name](table, chosen)
    assert found.columns == expected.columns
    assert rows_of(found) == rows_of(expected)


COMPARISONS = [periods.day_comparison, periods.week_comparison, periods.month_comparison]


@pytest.mark.parametrize(("pair", "operator"), list(zip(DATES.comparisons, COMPARISONS)))
def test_named_comparison_equals_operator(spark, table, pair, operator):
    table.createOrReplaceTempView("named_facts")
    found = named.named_query(
        spark, f"{pair.name}_comparison", "named_facts",
        current_start=pair.current.start, current_end=pair.current.end,
        previous_start=pair.previous.start, previous_end=pair.previous.end,
    )
    assert found.columns == operator(table, pair).columns
    assert rows_of(found) == rows_of(operator(table, pair))


def test_named_trend(spark, table):
    averages = daily.daily_average_table(table, DATES)
    averages.createOrReplaceTempView("named_averages")
    series = named.named_query(spark, "daily_trend", "named_averages", fy_start=YEAR.start, cutoff=DATES.cutoff)
    assert rows_of(series) == rows_of(trend.daily_trend(averages, DATES))


def test_a_bound_value_is_not_sql(spark, table):
    table.createOrReplaceTempView("named_facts")
    found = named.named_query(
        spark, "ytd_costs", "named_facts", fy_start=YEAR.start, cutoff=DATES.cutoff, cto="x' or '1' = '1"
    )
    assert found.count() == 0


def test_unknown_query_name(spark):
    with pytest.raises(KeyError):
        named.load_query("../schemas")


def test_report_sections_equal_the_operators_on_the_facts(table):
    sections = report.cost_report(table, DATES, 10)
    assert rows_of(sections["scorecard"]) == rows_of(periods.scorecard(table, DATES))
    assert rows_of(sections["period_matrix"]) == rows_of(periods.period_matrix(table, DATES))
    pillars = breakdowns.breakdown_table_pillar(breakdowns.pillar_costs(table, DATES, 10))
    assert rows_of(sections["pillars"]) == rows_of(pillars)
    products = breakdowns.breakdown_table_product(breakdowns.product_costs(table, DATES, 10))
    assert rows_of(sections["products"]) == rows_of(products)
    averages = daily.daily_average_table(table, DATES)
    by_env = trend.daily_trend_by_env(trend.daily_trend(averages, DATES))
    assert rows_of(sections["daily_trend"]) == rows_of(by_env)


def test_report_under_a_filter(table):
    chosen = CostFilter(cto="org1")
    sections = report.cost_report(table, DATES, 10, chosen)
    assert rows_of(sections["scorecard"]) == rows_of(periods.scorecard(table, DATES, chosen))
    assert {row.cto_org for row in sections["organisations"].collect()} == {"org1"}
    long = report.long_form(sections)
    assert {row.section for row in long.select("section").distinct().collect()} == set(sections)


def test_budget_schema():
    assert struct_of([("budget_amount", "FLOAT")]).simpleString() == "struct<budget_amount:double>"


def test_named_query_refuses_what_it_cannot_apply(spark, table):
    table.createOrReplaceTempView("named_facts")
    dates = {"fy_start": YEAR.start, "cutoff": DATES.cutoff}
    with pytest.raises(ValueError, match="pillar"):
        named.named_query(spark, "daily_trend", "named_facts", pillar="Data", **dates)
    with pytest.raises(ValueError, match="top"):
        named.named_query(spark, "ytd_costs", "named_facts", top=3, **dates)
    assert named.named_query(spark, "ytd_costs", "named_facts", pillar="", **dates).count() >= 0


def test_amounts_that_a_decimal_would_lose_are_errors(spark):
    for cost in (0.00004, 2e14):
        facts = spark.createDataFrame([(cost,)] * 3, "cost double")
        with pytest.raises(Exception, match="does not fit cost"):
            tables.conform_to_schema(facts, COST_FACTS).collect()
        kept = tables.conform_to_schema(facts, COST_FACTS_FLOAT).agg({"cost": "sum"}).first()[0]
        assert kept == pytest.approx(3 * cost)
    assert tables.conform_to_schema(spark.createDataFrame([("n/a",)], "cost string"), COST_FACTS).first().cost is None

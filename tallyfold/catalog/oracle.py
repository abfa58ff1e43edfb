"""SQL that gives the registered queries' results in DuckDB, written independently of the operators.

Every text starts from the full seven-table join, whatever tables the query itself joins.
Dates are spelled out: the report day is 1998-08-06, so the cut-off is 1998-08-03, the fiscal
year FY99 runs 1998-02-01 to 1999-01-31, FY98 and FY97 lie before it.
"""

from __future__ import annotations

import re

FACTS = """
facts as (
  select cast(l_shipdate as date) as date, r_name as cto, l_returnflag as cloud,
    p_type as tr_product_pillar_team, p_brand as tr_subpillar_name,
    concat('P', cast(p_partkey as varchar(20))) as tr_product_id, p_name as tr_product,
    c_mktsegment as managed_service,
    case o_orderpriority when '1-URGENT' then 'PROD' when '2-HIGH' then 'PROD'
      when '3-MEDIUM' then 'NON-PROD' when '4-NOT SPECIFIED' then 'PROD-DR' else 'DEV' end as environment,
    cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2))) as cost
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join customer on o_custkey = c_custkey
)"""

YTD = "date between date '1998-02-01' and date '1998-08-03'"
FY = "date between date '1998-02-01' and date '1999-01-31'"
PRIOR_FY = "date between date '1997-02-01' and date '1998-01-31'"
PRIOR_YTD = "date between date '1997-02-01' and date '1997-08-06'"
SECOND_PRIOR_FY = "date between date '1996-02-01' and date '1997-01-31'"
SPAN = "date between date '1996-02-01' and date '1999-01-31'"
DAY = "date = date '1998-08-03'"
DAY_BEFORE = "date = date '1998-08-02'"
WEEK = "date between date '1998-07-26' and date '1998-08-01'"
WEEK_BEFORE = "date between date '1998-07-19' and date '1998-07-25'"
MONTH = "date between date '1998-07-01' and date '1998-07-31'"
MONTH_BEFORE = "date between date '1998-06-01' and date '1998-06-30'"

EXACT = "case environment when 'PROD' then 'PROD' else 'NON-PROD' end"
PREFIX = "case left(environment, 4) when 'PROD' then 'PROD' else 'NON-PROD' end"
CONTAINS = "case when position('PROD' in environment) > 0 then 'PROD' else 'NON-PROD' end"

ALL_COLUMNS = (
    "date, cto, cloud, tr_product_pillar_team, tr_subpillar_name, tr_product_id, tr_product,"
    " managed_service, environment, cast(cost as double) as cost"
)
COUNTED = "count(*) as fact_count, cast(sum(cost) as double) as total_cost"


def _with(*parts: str) -> str:
    """``with`` clause of the facts and further views, then the final select."""
    *views, final = parts
    return "with " + ",".join([FACTS, *views]) + "\n" + final


def _sum(where: str) -> str:
    return f"coalesce(cast(sum(cost) filter (where {where}) as double), 0)"


def _environment_sums(where: str, **sums: str) -> str:
    columns = ", ".join(f"{_sum(condition)} as {name}" for name, condition in sums.items())
    return _with(f"select {EXACT} as environment_type, {columns} from facts where {where} group by 1")


def _direction(change: str) -> str:
    return (
        f"case sign({change}) when 1 then 'positive-change' when -1 then 'negative-change'"
        " else 'neutral-change' end"
    )


def _growth(current: str, prior: str) -> str:
    return f"case when {prior} > 0 then ({current} - {prior}) / {prior} * 100 else 0 end"


def _share(part: str, whole: str) -> str:
    return f"case when {whole} > 0 then {part} / {whole} * 100 else 0 end"


# --- breakdowns --------------------------------------------------------------------------------

AMOUNTS = f"""{_sum("environment = 'PROD'")} as prod_ytd_cost,
    {_sum("environment = 'NON-PROD'")} as nonprod_ytd_cost, cast(sum(cost) as double) as total_ytd_cost"""
AMOUNT_NAMES = "prod_ytd_cost, nonprod_ytd_cost, total_ytd_cost"
FORECAST = "total_ytd_cost * 365 / 183 as forecasted_cost"

CTO = f"""
cto_all as (
  select *, {FORECAST}, nonprod_ytd_cost / total_ytd_cost * 100 as nonprod_percentage
  from (select cto as cto_org, {AMOUNTS} from facts where {YTD} group by cto)
),
cto_top as (select * from cto_all order by total_ytd_cost desc, cto_org limit 10)"""

PILLAR = f"""
pillar_all as (
  select *, {FORECAST}
  from (
    select tr_product_pillar_team as pillar_name, count(distinct tr_product_id) as product_count, {AMOUNTS}
    from facts where {YTD} group by 1
  )
),
pillar_top as (
  select * from pillar_all where nonprod_ytd_cost > 0 order by nonprod_ytd_cost desc, pillar_name limit 10
)"""

PRODUCT_ORDER = "prod_ytd_cost desc, display_id, product_name, pillar_team, product_id, cto_org"
PRODUCT = f"""
product_all as (
  select pillar_team || ' - ' || product_id as display_id, *, {FORECAST}
  from (
    select tr_product as product_name, tr_product_pillar_team as pillar_team, tr_product_id as product_id,
      cto as cto_org, {AMOUNTS}
    from facts where {YTD} group by 1, 2, 3, 4
  )
),
product_top as (select * from product_all order by {PRODUCT_ORDER} limit 10)"""

FILLED = ", ".join(f"coalesce({name}, 0) as {name}" for name in AMOUNT_NAMES.split(", "))
PRODUCT_TABLE = f"""select display_id as product_id, product_name, pillar_team, {FILLED}, forecasted_cost,
  {_share("nonprod_ytd_cost", "total_ytd_cost")} as nonprod_percentage"""
CTO_TABLE = f"""select cto_org, {FILLED}, forecasted_cost,
  coalesce(nonprod_percentage, 0) as nonprod_percentage from cto_top"""
PILLAR_TABLE = f"""select pillar_name, product_count, {FILLED}, forecasted_cost,
  {_share("nonprod_ytd_cost", "total_ytd_cost")} as nonprod_percentage from pillar_top"""
PILLAR_TO_CTO = f"""select pillar_team, cto_org
  from (select *, row_number() over (order by {PRODUCT_ORDER}) as place from product_top)
  qualify row_number() over (partition by pillar_team order by place desc) = 1"""

ENVIRONMENT_ROWS = f"""
environment_rows as (
  select tr_product as product_name, environment,
    sum(case environment when 'PROD' then cost else 0 end) as prod_ytd_cost,
    sum(case environment when 'NON-PROD' then cost else 0 end) as nonprod_ytd_cost,
    sum(cost) as total_ytd_cost
  from facts where {YTD} group by 1, 2
)"""

# --- fiscal summary ----------------------------------------------------------------------------

SUMMARY = f"""
parts as (
  select {_sum(f"environment = 'PROD' and {YTD}")} as prod_ytd,
    {_sum(f"environment is distinct from 'PROD' and {YTD}")} as nonprod_ytd,
    {_sum(f"environment = 'PROD' and {FY}")} as prod_fy,
    {_sum(f"environment is distinct from 'PROD' and {FY}")} as nonprod_fy,
    {_sum(f"environment = 'PROD' and {PRIOR_YTD}")} as prod_prior,
    {_sum(f"environment is distinct from 'PROD' and {PRIOR_YTD}")} as nonprod_prior
  from facts
),
summary as (
  select *, prod_ytd + nonprod_ytd as total_ytd, prod_fy + nonprod_fy as total_fy,
    prod_prior + nonprod_prior as total_prior
  from parts
)"""

NOW_SHARE = _share("nonprod_ytd", "total_ytd")
PRIOR_SHARE = _share("nonprod_prior", "total_prior")
SHARE_CHANGE = f"case when total_prior > 0 then ({NOW_SHARE}) - ({PRIOR_SHARE}) else 0 end"
CHANGES = {
    "prod_ytd_percent": _growth("prod_ytd", "prod_prior"),
    "nonprod_ytd_percent": _growth("nonprod_ytd", "nonprod_prior"),
    "fy_ytd_percent": _growth("total_ytd", "total_prior"),
    "fy_percent": _growth("total_fy", "total_prior"),
    "nonprod_percentage_change": SHARE_CHANGE,
}
SCORECARD = f"""select prod_ytd as prod_ytd_cost, nonprod_ytd as nonprod_ytd_cost, prod_ytd as prod_fy_ytd_cost,
  nonprod_ytd as nonprod_fy_ytd_cost, total_ytd as total_fy_ytd_cost, prod_prior as prod_prior_cost,
  nonprod_prior as nonprod_prior_cost, total_prior as total_prior_ytd_cost, total_fy as total_fy_cost,
  {NOW_SHARE} as nonprod_percentage,
  {", ".join(f"{value} as {name}" for name, value in CHANGES.items())},
  {", ".join(f"{_direction(value)} as {name}_class" for name, value in CHANGES.items())}
  from summary"""

# --- period pairs ------------------------------------------------------------------------------

RECENT = {"day": (DAY, DAY_BEFORE), "week": (WEEK, WEEK_BEFORE), "month": (MONTH, MONTH_BEFORE)}
ALL_PERIODS = {**RECENT, "ytd": (YTD, PRIOR_YTD), "fiscal_year": (FY, PRIOR_FY)}


def _period_pairs(name: str, periods: dict[str, tuple[str, str]]) -> str:
    rows = [
        f"select '{period}' as period, '{label}' as environment_type,"
        f" {_sum(f'{test} and {now}')} as current_cost, {_sum(f'{test} and {before}')} as previous_cost from facts"
        for period, (now, before) in periods.items()
        for label, test in (("PROD", "environment = 'PROD'"), ("NON-PROD", "environment is distinct from 'PROD'"))
    ]
    change = "case when previous_cost > 0 then (current_cost / previous_cost - 1) * 100 else 0 end"
    return f"""
{name} as (
  select *, {_direction("percent_change")} as direction
  from (select *, {change} as percent_change from ({" union all ".join(rows)}))
)"""


# --- daily averages ----------------------------------------------------------------------------


def _average(where: str) -> str:
    return (
        f"cast(sum(cost) filter (where {where}) as double) / nullif(count(distinct date) filter (where {where}), 0)"
    )


def _averages(name: str, label: str) -> str:
    return f"""
{name} as (
  select {label} as environment_type, cto,
    round({_average(SECOND_PRIOR_FY)}, 2) as fy97_avg_daily_spend,
    round({_average(PRIOR_FY)}, 2) as fy98_avg_daily_spend,
    round({_average(YTD)}, 2) as fy99_ytd_avg_daily_spend,
    round(({_average(YTD)}) * 1.15::double, 2) as fy99_forecasted_avg_daily_spend,
    round({_average(FY)}, 2) as fy99_avg_daily_spend
  from facts where {SPAN} group by 1, 2
)"""


def _days(name: str, label: str, where: str = SPAN) -> str:
    return f"""
{name} as (
  select date, {label} as environment_type, cto, cast(round(sum(cost), 2) as double) as daily_cost
  from facts where {where} group by 1, 2, 3
)"""


FY_COLUMNS = [
    "fy97_avg_daily_spend",
    "fy98_avg_daily_spend",
    "fy99_ytd_avg_daily_spend",
    "fy99_forecasted_avg_daily_spend",
    "fy99_avg_daily_spend",
]
AVERAGE_TABLE = (
    _averages("averages", PREFIX)
    + ","
    + _days("days", PREFIX)
    + f""",
average_table as (
  select date, environment_type, cto, {", ".join(f"coalesce({name}, 0) as {name}" for name in FY_COLUMNS)}, daily_cost
  from days left join averages using (environment_type, cto)
)"""
)
AVERAGE_COLUMNS = "date, environment_type, cto, " + ", ".join(FY_COLUMNS) + ", daily_cost"
READ_AVERAGES = _with(AVERAGE_TABLE, f"select {AVERAGE_COLUMNS} from average_table")

SEGMENT = "case when date > date '1998-08-03' then 'Forecast' else 'Actual' end"
SERIES = {
    "PROD Daily Cost (FY99)": ("daily_cost", "PROD"),
    "NON-PROD Daily Cost (FY99)": ("daily_cost", "NON-PROD"),
    "FY99 Avg Daily Spend": ("fy99_avg_daily_spend", "PROD"),
    "FY98 Avg Daily Spend": ("fy98_avg_daily_spend", "PROD"),
}
TREND_SERIES = " union all ".join(
    f"select '{name}' as series, {SEGMENT} as segment, date, cto, coalesce({column}, 0) as value"
    f" from average_table where environment_type = '{environment}' and {FY}"
    for name, (column, environment) in SERIES.items()
)
TREND_BY_ENV = f"""select date, environment_type, cast(sum(cast(daily_cost as decimal(18,2))) as double) as daily_cost
  from average_table where {YTD} group by 1, 2"""

# --- value lists -------------------------------------------------------------------------------


def _value_lists(where: str) -> str:
    return f"""select * from (
  select distinct 'cto' as list_name, cto as value, null::varchar as product_name,
    null::varchar as pillar_team, cto as display from facts where {where}
  union all
  select distinct 'pillar', tr_product_pillar_team, null, null, tr_product_pillar_team from facts where {where}
  union all
  select distinct 'product', tr_product_id, tr_product, tr_product_pillar_team,
    tr_product_pillar_team || ' - ' || tr_product_id from facts where {where}
  ) where value is not null"""


# --- report in long form -----------------------------------------------------------------------


def _long(section: str, source: str, keys: list[str], metrics: list[str]) -> str:
    item = "concat_ws('|', " + ", ".join(f"coalesce(cast({key} as varchar), '')" for key in keys) + ")" if keys else "''"
    measured = {name: f"cast({name} as double)" for name in metrics} or {"present": "cast(1 as double)"}
    return " union all ".join(
        f"select '{section}' as section, {item} as item, '{name}' as metric, {value} as value from ({source})"
        for name, value in measured.items()
    )


def _bars(section: str, source: str, keys: list[str]) -> str:
    """Both environments of a breakdown table in percent, and the mark above 30 percent."""

    def share(part: str) -> str:
        return f"coalesce(round({part} / nullif(prod_ytd_cost + nonprod_ytd_cost, 0) * 100, 1), 0)"

    bars = f"""select *, {share('prod_ytd_cost')} as prod_share, {share('nonprod_ytd_cost')} as nonprod_share,
      coalesce(nonprod_percentage > 30, false)::int as over_threshold from ({source})"""
    return _long(section, bars, keys, ["prod_share", "nonprod_share", "over_threshold"])


def _report() -> str:
    classes = [f"{name}_class" for name in CHANGES]
    amounts = AMOUNT_NAMES.split(", ")
    scorecard = [
        "prod_ytd_cost", "nonprod_ytd_cost", "prod_fy_ytd_cost", "nonprod_fy_ytd_cost", "total_fy_ytd_cost",
        "prod_prior_cost", "nonprod_prior_cost", "total_prior_ytd_cost", "total_fy_cost", "nonprod_percentage",
        *CHANGES,
    ]
    period_keys, period_metrics = (
        ["period", "environment_type", "direction"],
        ["current_cost", "previous_cost", "percent_change"],
    )
    table_metrics = [*amounts, "forecasted_cost", "nonprod_percentage"]
    sections = [
        _long("scorecard", SCORECARD, classes, scorecard),
        _long("comparisons", "select * from recent", period_keys, period_metrics),
        _long("period_matrix", "select * from all_periods", period_keys, period_metrics),
        _long("products", f"{PRODUCT_TABLE} from product_top", ["product_id", "product_name", "pillar_team"],
              table_metrics),
        _long("organisations", CTO_TABLE, ["cto_org"], table_metrics),
        _long("pillars", PILLAR_TABLE, ["pillar_name"], ["product_count", *table_metrics]),
        _bars("product_shares", f"{PRODUCT_TABLE} from product_top", ["product_id", "product_name", "pillar_team"]),
        _bars("organisation_shares", CTO_TABLE, ["cto_org"]),
        _bars("pillar_shares", PILLAR_TABLE, ["pillar_name"]),
        _long("pillar_to_cto", PILLAR_TO_CTO, ["pillar_team", "cto_org"], []),
        _long("daily_trend", TREND_BY_ENV, ["date", "environment_type"], ["daily_cost"]),
        _long("trend_series", TREND_SERIES, ["series", "segment", "date", "cto"], ["value"]),
        _long("filter_values", _value_lists("true"),
              ["list_name", "value", "product_name", "pillar_team", "display"], []),
    ]
    return _with(
        SUMMARY,
        _period_pairs("recent", RECENT),
        _period_pairs("all_periods", ALL_PERIODS),
        CTO,
        PILLAR,
        PRODUCT,
        AVERAGE_TABLE,
        " union all ".join(sections),
    )


def _filtered(where: str) -> str:
    keys = "date, environment, cto, tr_product_pillar_team, tr_product_id"
    return _with(f"select {keys}, {COUNTED} from facts where {where} group by all")


def _by_day(where: str) -> str:
    return _with(f"select date, environment, {COUNTED} from facts where {where} group by all")


def _classified(label: str) -> str:
    return _with(f"select environment, {label} as environment_type, {COUNTED} from facts group by all")


def _of_days(columns: str) -> str:
    return _with(f"select date, {columns} from (select distinct date from facts)")


_YTD_ROWS = f"select {EXACT} as environment_type, cast(sum(cost) as double) as ytd_cost from facts where {YTD} group by 1"
_FACT_ROWS = _with(f"select {ALL_COLUMNS} from facts")
_COMBINATION = "cto, tr_product_pillar_team, tr_product_id"
_GRID = """
grid as (
  select d.date, p.*, e.environment, c.cloud
  from (select distinct tr_product_pillar_team, tr_subpillar_name from facts) p,
    (select cast(unnest(generate_series(date '1997-02-01', date '1998-08-03', interval 1 day)) as date) as date) d,
    (select unnest(['PROD', 'NON-PROD']) as environment) e, (select unnest(['A', 'N', 'R']) as cloud) c
)"""

_WEEKEND = "isodow(date) >= 6"
_DAYS_IN = "date_diff('day', date '1997-02-01', date)"


def _cents(value: str) -> str:
    return f"cast(round(cast({value} as decimal(28,8)), 2) as double)"


def _seasonal() -> str:
    level = f"base * (case when {_WEEKEND} then 0.7 else 1.0 end)::double"
    forecast = f"{level} * (1 + {_DAYS_IN} / 180::double * 0.08::double)"
    month_end = "day(last_day(date)) - day(date) < 5"
    return _with(
        f"""select date, cloud, base as base_cost,
        {_cents(f"base * (case when {_WEEKEND} then 0.6 else 1.0 end)::double * (case when {month_end} then 1.2 else 1.0 end)::double * (1 + {_DAYS_IN} / 365::double * 0.12::double)")} as seasonal_cost,
        {_cents(f"{level} * 0.85::double")} as second_prior_avg, {_cents(f"{level} * 0.92::double")} as prior_avg,
        {_cents(f"{level} * 0.97::double")} as ytd_avg, {_cents(forecast)} as forecasted_avg,
        {_cents(f"({level} * 0.97::double + {forecast}) / 2")} as current_avg,
        {_cents(f"{level} * (1 + {_DAYS_IN} / 365::double * 0.15::double)")} as daily_cost
      from (select date, cloud, cast(max(cost) as double) as base from facts group by 1, 2)"""
    )


def _money_labels() -> str:
    share = "round(prod_ytd_cost / nullif(prod_ytd_cost + nonprod_ytd_cost, 0) * 100, 1)"
    dollars = "'$' || format('{:,.2f}', prod_ytd_cost)"
    return _with(
        PILLAR,
        f"""select pillar_name, {dollars} as currency_label,
        format('${{:.0f}} ({{:.1f}}%)', prod_ytd_cost, {share}) as bar_label,
        format('${{:.2f}}M ({{:.1f}}%)', prod_ytd_cost / 1000000, {share}) as millions_label,
        {dollars} || ' (' || product_count || ' products)' as products_label from pillar_all""",
    )


def _chosen(text: str, further: str = "") -> str:
    """The same text over the facts of one organisation and pillar."""
    head, tail = text.split(FACTS, 1)
    view = f", chosen_facts as (select * from facts where cto = 'ASIA' and tr_product_pillar_team = 'PROMO'{further})"
    return head + FACTS + view + re.sub(r"\bfacts\b", "chosen_facts", tail)


def _scorecards() -> str:
    keys = "cto, tr_product_pillar_team, tr_product_id"
    parts = SUMMARY.replace("select", f"select {keys}, grouping({keys}) as unset,", 1).replace(
        "from facts", f"from (select * from facts where {YTD} or {FY} or {PRIOR_YTD}) group by cube ({keys})", 1
    )
    named = "concat_ws(',', if(unset & 4 = 0, 'cto', null), if(unset & 2 = 0, 'pillar', null), if(unset & 1 = 0, 'product', null))"
    columns = f"select {named} as chosen_by, cto, tr_product_pillar_team as pillar, tr_product_id as product,"
    known = " and ".join(f"(unset & {bit} > 0 or {key} is not null)" for bit, key in zip((4, 2, 1), keys.split(", ")))
    return _with(parts, SCORECARD.replace("select", columns, 1) + f" where {known}")


def oracle_texts() -> dict[str, str]:
    """SQL per registered query."""
    texts = _texts()
    trend = _with(_days("days", PREFIX, YTD), "select date, environment_type, daily_cost from days")
    return texts | {
        "filtered_scorecard": _chosen(texts["scorecard"]),
        "filtered_product_costs": _chosen(texts["product_costs"]),
        "filtered_daily_trend": _chosen(trend),
        # The lists to choose from hold all facts.
        "filtered_cost_report": _chosen(texts["cost_report"], " and tr_product_id = 'P177'").replace("from chosen_facts where true", "from facts where true"),
    }


def _texts() -> dict[str, str]:
    report = _report()
    month = "cast(month || '-01' as date)"
    return {
        # sources and sinks
        "scan_cost_facts": _FACT_ROWS,
        "scan_daily_averages": READ_AVERAGES,
        "conform_to_schema": _FACT_ROWS,
        "csv_load_declared": _FACT_ROWS,
        "csv_load_inferred": _FACT_ROWS,
        "csv_load_table": _with(
            """select * replace (if(cloud = 'N', null, cast(cost as double)) as cost,
                '00' || substr(tr_product_id, 2) as tr_product_id), coalesce(cloud <> 'N', true) as known from ("""
            f"select {ALL_COLUMNS} from facts)"
        ),
        "csv_load_rejects": _with(
            f"select if(tr_product_id is not distinct from 'P17', 'reject', 'row') as kind,"
            " if(kind = 'reject', 'cost', null) as reason, tr_product_pillar_team, count(*) as fact_count,"
            " cast(sum(if(kind = 'reject', null, cost)) as double) as total_cost from facts group by all"
        ),
        "reconcile_load": _with(
            "select date, count(*) as loaded_rows, count(*) as expected_rows, true as same_count from facts group by date"
            f" having count(if(cto = 'ASIA' and tr_product_id = 'P17', cost, null)) > 0"
        ),
        "csv_write": _with(
            f"select header, date, cloud, {COUNTED} from facts, (select unnest([true, false]) as header) group by all"
        ),
        "replace_table": _with(f"select {ALL_COLUMNS}, strftime(date, '%Y-%m') as month from facts"),
        "verify_row_count": _with(
            "select count(*) as loaded_rows, (select count(*) from lineitem) as expected_rows,"
            " count(*) = (select count(*) from lineitem) as row_counts_match from facts"
        ),
        "create_daily_average_view": READ_AVERAGES,
        "stored_daily_averages": READ_AVERAGES,
        "union_sources": _with(
            f"select {ALL_COLUMNS.replace('tr_subpillar_name', 'nullif(tr_subpillar_name, if(cloud = $$N$$, tr_subpillar_name, null)) as tr_subpillar_name')} from facts"
        ),
        "grid_sample": _with(
            _GRID,
            """select * from grid where cast('0x' || substr(md5(concat_ws('|', cast(date as varchar),
              coalesce(tr_product_pillar_team, ''), coalesce(tr_subpillar_name, ''), environment, cloud)), 1, 8) as bigint) % 100 < 30""",
        ),
        "write_report_tables": report,
        "named_query": _with(CTO, "select * from cto_top"),
        # scalar derivations
        "classify_env_exact": _classified(EXACT),
        "classify_env_prefix": _classified(PREFIX),
        "classify_env_contains": _classified(CONTAINS),
        "product_display_id": _with(
            "select distinct tr_product_pillar_team, tr_product_id,"
            " tr_product_pillar_team || ' - ' || tr_product_id as display_id from facts"
        ),
        "money_labels": _money_labels(),
        "scale_to_millions": _with(f"select *, ytd_cost / 1000000 as ytd_cost_millions from ({_YTD_ROWS})"),
        "change_direction": _with(
            _period_pairs("recent", RECENT),
            f"""select period, environment_type, current_cost - previous_cost as change,
              {_direction("current_cost - previous_cost")} as direction from recent""",
        ),
        "coerce_numeric": _with(
            """select tr_subpillar_name, tr_product_id,
              coalesce(try_cast(tr_subpillar_name as double), 0) as subpillar_number,
              coalesce(try_cast(substr(tr_product_id, 2) as double), 0) as product_number,
              cast(max(cost) as double) as cost_number from facts group by 1, 2"""
        ),
        "month_bounds": _with(
            f"""select month, {month} as month_start, last_day({month}) as month_end
              from (select distinct strftime(date, '%Y-%m') as month from facts)"""
        ),
        "period_labels": _of_days(
            "strftime(date, '%b %Y') as month_label,"
            " strftime(date - 6, '%b %d') || ' - ' || strftime(date, '%b %d, %Y') as week_label"
        ),
        "relative_periods": _of_days(
            """date as day_current, date - 1 as day_previous,
              cast(date_trunc('week', date) as date) - 7 as week_current_start,
              cast(date_trunc('week', date) as date) - 1 as week_current_end,
              cast(date_trunc('week', date) as date) - 14 as week_previous_start,
              cast(date_trunc('week', date) as date) - 8 as week_previous_end,
              cast(date_trunc('month', date) as date) as month_current,
              cast(date_trunc('month', date) - interval 1 month as date) as month_previous"""
        ),
        "report_window": _of_days("date - 90 as report_start_date, date - 3 as report_end_date"),
        "fiscal_year_of": _with(
            """select date, fy as fiscal_year, make_date(fy - 1, 2, 1) as fiscal_year_start,
              make_date(fy, 1, 31) as fiscal_year_end,
              date_diff('day', make_date(fy - 1, 2, 1), date) + 1 as day_of_fiscal_year
              from (select distinct date, year(date) + (month(date) > 1)::int as fy from facts)"""
        ),
        "seasonal_cost_model": _seasonal(),
        "fill_missing_costs": _with(
            PRODUCT,
            """select product_name, pillar_team, product_id, cto_org, prod_ytd_cost, nonprod_ytd_cost,
              case when total_ytd_cost <> nonprod_ytd_cost then total_ytd_cost
                when prod_ytd_cost > 0 or nonprod_ytd_cost > 0 then prod_ytd_cost + nonprod_ytd_cost
                else 0 end as total_ytd_cost from product_all""",
        ),
        "env_columns_from_rows": _with(
            ENVIRONMENT_ROWS,
            """select product_name, environment, prod_ytd_cost::double as prod_ytd_cost,
              nonprod_ytd_cost::double as nonprod_ytd_cost, total_ytd_cost::double as total_ytd_cost
              from environment_rows""",
        ),
        # filters
        "filter_cto": _filtered("cto = 'ASIA'"),
        "filter_pillar": _filtered("tr_product_pillar_team = 'PROMO'"),
        "filter_product": _filtered("tr_product_id = 'P17'"),
        "filter_combined": _filtered("cto = 'ASIA' and tr_product_pillar_team = 'PROMO'"),
        "filter_combination_exists": _with(
            f"""select * from (
              select {_COMBINATION} from facts where {PRIOR_FY} intersect select {_COMBINATION} from facts where {FY}
            ) where cto is not null and tr_product_pillar_team is not null and tr_product_id is not null"""
        ),
        "date_between": _by_day(FY),
        "date_in": _by_day("date in (date '1998-08-03', date '1998-08-02')"),
        "complete_days_only": _by_day("date <= date '1998-08-03'"),
        "env_filter_case_insensitive": _by_day("lower(environment) = 'non-prod'"),
        "nonprod_over_threshold": _with(
            PRODUCT, f"select *, nonprod_percentage > 30 as over_threshold from ({PRODUCT_TABLE} from product_all)"
        ),
        "forecast_not_null": _with(
            AVERAGE_TABLE,
            """select date, environment_type, cto, averages.fy99_forecasted_avg_daily_spend
              from days join averages using (environment_type, cto)
              where averages.fy99_forecasted_avg_daily_spend is not null""",
        ),
        "null_safe_ratio_guard": _with(
            PRODUCT,
            """select pillar_team, product_id, cto_org,
              nonprod_ytd_cost / nullif(prod_ytd_cost, 0) as nonprod_to_prod from product_all""",
        ),
        # joins
        "daily_average_table": READ_AVERAGES,
        "daily_average_table_inner": _with(
            AVERAGE_TABLE,
            f"select {AVERAGE_COLUMNS} from days join averages using (environment_type, cto)",
        ),
        "calendar_dimension_grid": _with(_GRID, "select * from grid"),
        "add_missing_environments": _with(
            _days("current_days", PREFIX, YTD),
            _days("prior_days", PREFIX, PRIOR_FY),
            """select date, environment_type, cto, daily_cost from current_days where environment_type = 'PROD'
              union all
              select date, environment_type, cto, daily_cost from prior_days where environment_type = 'NON-PROD'""",
        ),
        "budget_unplanned": _with(
            f"""spent as (select environment as environment_type, cast(sum(cost) as double) as spent
              from facts where {FY} and environment <> 'DEV' group by 1),
            planned as (select environment as environment_type, cast(sum(cost) as double) * 1.05::double as planned
              from facts where {PRIOR_FY} and environment <> 'PROD' group by 1),
            both_sides as (select coalesce(s.environment_type, p.environment_type) as environment_type,
              coalesce(planned, 0) as budget_amount, coalesce(spent, 0) as actual_cost
              from spent s full join planned p on s.environment_type = p.environment_type)""",
            """select environment_type, budget_amount, actual_cost, actual_cost - budget_amount as variance_amount,
              case when budget_amount <> 0 then (actual_cost - budget_amount) / budget_amount * 100 end as variance_percent,
              case when actual_cost > budget_amount then 'over' when actual_cost < budget_amount then 'under'
                else 'on budget' end as budget_status from both_sides""",
        ),
        "budget_variance": _with(
            f"""actuals as (
              select {EXACT} as environment_type, {_sum(FY)} as actual_cost,
                ({_sum(PRIOR_FY)}) * 1.05::double as budget_amount from facts group by 1
            )""",
            """select environment_type, budget_amount, actual_cost, actual_cost - budget_amount as variance_amount,
              (actual_cost - budget_amount) / budget_amount * 100 as variance_percent,
              case when actual_cost > budget_amount then 'over' when actual_cost < budget_amount then 'under'
                else 'on budget' end as budget_status from actuals""",
        ),
        "prior_year_join": _with(
            f"""aligned as (
              select {EXACT} as environment_type, {_sum(YTD)} as ytd_cost, {_sum(PRIOR_YTD)} as prior_ytd_cost
              from facts where {YTD} or {PRIOR_YTD} group by 1
            )""",
            f"select *, {_growth('ytd_cost', 'prior_ytd_cost')} as percent_change from aligned",
        ),
        # aggregates
        "ytd_costs": _with(_YTD_ROWS),
        "fy_ytd_costs": _with(_YTD_ROWS),
        "fy_total_costs": _environment_sums(FY, total_cost="true"),
        "prior_fy_costs": _environment_sums(PRIOR_FY, total_cost="true", ytd_cost="date <= date '1997-08-06'"),
        "day_comparison": _environment_sums(
            f"{DAY} or {DAY_BEFORE}", day_current_cost=DAY, day_previous_cost=DAY_BEFORE
        ),
        "week_comparison": _environment_sums(
            f"{WEEK} or {WEEK_BEFORE}", this_week_cost=WEEK, prev_week_cost=WEEK_BEFORE
        ),
        "month_comparison": _environment_sums(
            f"{MONTH} or {MONTH_BEFORE}", this_month_cost=MONTH, prev_month_cost=MONTH_BEFORE
        ),
        "cto_costs": _with(CTO, "select * from cto_top"),
        "pillar_costs": _with(PILLAR, "select * from pillar_top"),
        "product_costs": _with(PRODUCT, "select * from product_top"),
        "env_pivot_sums": _with(CTO, f"select cto_org, {AMOUNT_NAMES} from cto_all"),
        "distinct_product_count": _with(
            "select tr_product_pillar_team as pillar_name, count(distinct tr_product_id) as product_count"
            " from facts group by 1"
        ),
        "sketched_product_counts": _with(
            """pairs as (select distinct date_trunc('month', date)::date as month, tr_product_pillar_team as pillar_name,
                tr_product_id as product from facts where date is not null)""",
            """select month, pillar_name, count(distinct product) as month_products,
                (select count(distinct q.product) from pairs q where q.pillar_name is not distinct from p.pillar_name
                   and q.month between p.month - interval 2 month and p.month) as quarter_products
              from pairs p group by 1, 2""",
        ),
        "having_nonprod": _with(
            PRODUCT,
            f"select product_name, pillar_team, product_id, cto_org, {AMOUNT_NAMES}"
            " from product_all where nonprod_ytd_cost > 0",
        ),
        "fiscal_year_averages": _with(_averages("averages", PREFIX), "select * from averages"),
        "conditional_distinct_days": _with(
            f"""select {PREFIX} as environment_type, cto,
              count(distinct date) filter (where {SECOND_PRIOR_FY}) as second_prior_days,
              count(distinct date) filter (where {PRIOR_FY}) as prior_days,
              count(distinct date) filter (where {YTD}) as ytd_days,
              count(distinct date) filter (where {FY}) as current_days
              from facts where {SPAN} group by 1, 2"""
        ),
        "daily_costs": _with(_days("days", CONTAINS), "select * from days"),
        "env_mean_baseline": _with(
            _days("days", PREFIX, YTD),
            """means as (
              select environment_type,
                sum(cast(daily_cost as decimal(18,2)))::double / count(daily_cost) as mean from days group by 1
            )""",
            """select date, environment_type, daily_cost, mean as current_avg_daily_spend,
              mean * 0.8::double as prior_avg_daily_spend from days join means using (environment_type)""",
        ),
        "environment_breakdown": _with(
            SUMMARY,
            f"""select prod_ytd as prod_cost, nonprod_ytd as nonprod_cost, total_ytd as total_cost,
              {_share("prod_ytd", "total_ytd")} as prod_percentage, {NOW_SHARE} as nonprod_percentage from summary""",
        ),
        "top_rows_then_rollup": _with(
            ENVIRONMENT_ROWS,
            """largest as (
              select * from environment_rows order by total_ytd_cost desc, product_name, environment limit 10
            )""",
            f"""select *, {_share("nonprod_ytd_cost", "total_ytd_cost")} as nonprod_percentage
              from (select product_name, sum(prod_ytd_cost)::double as prod_ytd_cost,
                sum(nonprod_ytd_cost)::double as nonprod_ytd_cost, sum(total_ytd_cost)::double as total_ytd_cost
                from largest group by 1)""",
        ),
        "grand_totals": _with(
            SUMMARY,
            "select total_ytd as total_fy_ytd_cost, total_fy as total_fy_cost,"
            " total_prior as total_prior_ytd_cost from summary",
        ),
        # order, lists
        "top_n_cto": _with(CTO, "select cto_org, total_ytd_cost from cto_all order by 2 desc, 1 limit 3"),
        "top_n_pillar": _with(
            PILLAR,
            "select pillar_name, nonprod_ytd_cost from pillar_all where nonprod_ytd_cost > 0"
            " order by 2 desc, 1 limit 3",
        ),
        "top_n_product": _with(
            PRODUCT,
            f"select display_id, cto_org, prod_ytd_cost from product_all order by {PRODUCT_ORDER} limit 25",
        ),
        "chart_order": _with(
            PILLAR,
            """select row_number() over (order by total_ytd_cost, pillar_name desc) as rank, pillar_name, total_ytd_cost
              from (select * from pillar_all order by total_ytd_cost desc, pillar_name limit 5)""",
        ),
        "trend_order": READ_AVERAGES,
        "filter_value_lists": _with(_value_lists("true")),
        "distinct_values": _with("select distinct date, environment from facts"),
        # composite analytics
        "percent_change_comparison": _with(_period_pairs("recent", RECENT), "select * from recent"),
        "yoy_ytd_change": _with(
            SUMMARY,
            f"""select *, {_direction("percent_change")} as direction from (
              select *, {_growth("ytd_cost", "prior_ytd_cost")} as percent_change from (
                select 'PROD' as scope, prod_ytd as ytd_cost, prod_prior as prior_ytd_cost from summary
                union all select 'NON-PROD', nonprod_ytd, nonprod_prior from summary
                union all select 'TOTAL', total_ytd, total_prior from summary))""",
        ),
        "projected_vs_prior_ytd": _with(
            SUMMARY,
            f"""select total_fy as total_fy_cost, total_prior as total_prior_ytd_cost,
              {_growth("total_fy", "total_prior")} as fy_percent from summary""",
        ),
        "nonprod_share_change": _with(
            SUMMARY,
            f"""select {NOW_SHARE} as nonprod_percentage, {PRIOR_SHARE} as prior_nonprod_percentage,
              {SHARE_CHANGE} as nonprod_percentage_change from summary""",
        ),
        "scorecard": _with(SUMMARY, SCORECARD),
        "period_matrix": _with(_period_pairs("all_periods", ALL_PERIODS), "select * from all_periods"),
        "span_costs": _with(
            """spans as (
              select n || ' days to ' || strftime(d, '%Y-%m-%d') as name, (d - n + 1)::date as s, d as e
              from (select unnest(generate_series(date '1997-02-01', date '1998-08-03', interval 1 day))::date as d), (select unnest([7, 30, 90])::int as n)
              union all
              select 'year to ' || strftime(d, '%Y-%m-%d'), if(d < date '1998-02-01', date '1997-02-01', date '1998-02-01'), d
              from (select unnest(generate_series(date '1997-02-01', date '1998-08-03', interval 1 day))::date as d)
            ),
            days as (select date, environment, sum(cost) as cost from facts group by all)""",
            """select name, environment_type, coalesce(cast(sum(cost) filter (where (environment is not distinct from 'PROD') = (environment_type = 'PROD')) as double), 0) as cost
              from spans cross join (select unnest(['PROD', 'NON-PROD']) as environment_type)
              left join days on date between s and e group by 1, 2""",
        ),
        "scorecards": _scorecards(),
        "run_rate_forecast": _with(f"select *, ytd_cost * 365 / 183 as forecasted_cost from ({_YTD_ROWS})"),
        "run_rate_forecast_python": _with(f"select *, ytd_cost * 365 / 186 as forecasted_cost from ({_YTD_ROWS})"),
        "growth_forecast": _with(
            _averages("averages", PREFIX),
            "select environment_type, cto, fy99_ytd_avg_daily_spend, fy99_forecasted_avg_daily_spend from averages",
        ),
        "forecast_band": _with(
            AVERAGE_TABLE,
            """select date, environment_type, cto, daily_cost, fy99_forecasted_avg_daily_spend as forecast,
              fy99_forecasted_avg_daily_spend * 0.9::double as forecast_low,
              fy99_forecasted_avg_daily_spend * 1.1::double as forecast_high from average_table""",
        ),
        "daily_trend": _with(
            _days("days", PREFIX, YTD), "select date, environment_type, daily_cost from days"
        ),
        "daily_trend_by_env": _with(AVERAGE_TABLE, TREND_BY_ENV),
        "trend_series": _with(AVERAGE_TABLE, TREND_SERIES),
        "actual_forecast_split": _with(_days("days", PREFIX, FY), f"select *, {SEGMENT} as segment from days"),
        "stacked_share": _with(
            CTO,
            """select cto_org, round(prod_ytd_cost / (prod_ytd_cost + nonprod_ytd_cost) * 100, 1) as prod_share,
              round(nonprod_ytd_cost / (prod_ytd_cost + nonprod_ytd_cost) * 100, 1) as nonprod_share from cto_all""",
        ),
        "breakdown_table_product": _with(PRODUCT, f"{PRODUCT_TABLE} from product_top"),
        "breakdown_table_cto": _with(CTO, CTO_TABLE),
        "breakdown_table_pillar": _with(PILLAR, PILLAR_TABLE),
        "pillar_to_cto": _with(PRODUCT, PILLAR_TO_CTO),
        "cost_report": report,
        "incremental_report": report,
    }

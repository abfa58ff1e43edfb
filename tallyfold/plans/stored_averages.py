"""The daily-average table kept as files by month; a refresh rewrites only the months whose facts changed.

Stored are the exact costs per (date, environment, organisation), a folder per month, and the
fiscal-year averages per environment and organisation, which every day of a group shows. They are kept apart
because one late cost changes the averages of its group on every day, but the costs of one month.
One note names the folder of each month, the number and the sum of hashes of the facts it was made
from, and the folder of the averages. A refresh writes new folders beside the old ones and replaces the
note last, so readers find the old state or the new one, and one that fails changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators.daily import GROUP, averages_of_rollup, daily_rollup, table_of_parts
from tallyfold.plans.dates import DateRange, ReportDates, covering, month_range, within
from tallyfold.sources.versions import new_version, read_note, remove_folders, write_note

_COSTS = T.StructType(
    [T.StructField("date", T.DateType()), *[T.StructField(name, T.StringType()) for name in GROUP], T.StructField("cost", T.DecimalType(28, 4))]
)


def _note(root: str) -> str:
    return f"{root.rstrip('/')}/_months"


def _state(spark: SparkSession, root: str) -> dict:
    return read_note(spark, _note(root)) or {"months": {}}


def month_prints(facts: DataFrame, spans: Iterable[DateRange]) -> DataFrame:
    """Per month the number of facts and an order-free sum of their hashes; what the table does not show is not hashed."""
    hashed = "string(sum(cast(xxhash64(date, environment, cto, cast(cost as decimal(28, 4))) as decimal(20, 0)))) as hashed"
    return facts.filter(within(spans)).groupBy(F.expr("date_format(date, 'yyyy-MM') as month")).agg(F.expr("count(*) as n"), F.expr(hashed))


def _overlap(one: DateRange, other: DateRange) -> DateRange:
    return DateRange(max(one.start, other.start), min(one.end, other.end))


def refresh_averages(
    facts: DataFrame, root: str, dates: ReportDates, changed: Iterable[str] | None = None, mode: str = "prefix"
) -> list[str]:
    """Bring the stored table below ``root`` up to date; returns the months rewritten or dropped.

    ``changed`` names the months (``YYYY-MM``) that can differ from the last refresh, and only these are read. Without
    it one pass over four columns of the facts compares every month with its note.
    """
    spark, root, span = facts.sparkSession, root.rstrip("/"), dates.average_span
    state = _state(spark, root)
    asked = None if changed is None else sorted(set(changed))
    spans = [span] if asked is None else [_overlap(month_range(month), span) for month in asked]
    # A month that lies partly outside the table's span is noted by what lies inside.
    prints = {row.month: [row.n, row.hashed] for row in month_prints(facts, covering(spans)).collect()}
    months = {m: known for m, known in state["months"].items() if month_range(m).end >= span.start and month_range(m).start <= span.end}
    due = [month for month, found in prints.items() if months.get(month, {}).get("facts") != found]
    gone = [month for month in months if month not in prints and (asked is None or month in asked)]
    key = {"mode": mode, "span": [span.start.isoformat(), span.end.isoformat()], "cutoff": dates.cutoff.isoformat()}
    if not due and not gone and state.get("key") == key and "averages" in state:
        return []
    if state.get("key", key)["mode"] != mode:
        raise ValueError(f"the table at {root} is stored with mode {state['key']['mode']}")
    folder = new_version(root)
    if due:
        wanted = facts.filter(within([_overlap(month_range(month), span) for month in due]))
        costs = daily_rollup(wanted, span, mode).selectExpr("date", *GROUP, "cast(cost as decimal(28, 4)) as cost", "date_format(date, 'yyyy-MM') as month")
        costs.hint("rebalance", "month").write.partitionBy("month").parquet(f"{folder}/costs")
    below = folder.removeprefix(root + "/")
    kept = {month: known for month, known in months.items() if month not in gone}
    kept |= {month: {"folder": f"{below}/costs/month={month}", "facts": prints[month]} for month in due}
    averages = averages_of_rollup(_costs(spark, root, kept), dates)
    averages.write.parquet(f"{folder}/averages")
    write_note(spark, _note(root), {"key": key, "months": kept, "averages": f"{below}/averages", "schema": averages.schema.jsonValue()})
    return sorted({*due, *gone})


def _costs(spark: SparkSession, root: str, months: dict) -> DataFrame:
    paths = [f"{root.rstrip('/')}/{known['folder']}" for known in months.values()]
    return spark.read.schema(_COSTS).parquet(*paths) if paths else spark.createDataFrame([], _COSTS)


def read_averages(spark: SparkSession, root: str, dates: ReportDates, span: DateRange | None = None) -> DataFrame:
    """The daily-average table from its files; only the months of ``span`` are opened."""
    state = _state(spark, root)
    wanted = {m: known for m, known in state["months"].items() if span is None or (month_range(m).end >= span.start and month_range(m).start <= span.end)}
    costs = _costs(spark, root, wanted)
    if span is not None:
        costs = costs.filter(span.contains())
    if "averages" not in state:
        raise ValueError(f"no daily averages are stored at {root}")
    averages = spark.read.schema(T.StructType.fromJson(state["schema"])).parquet(f"{root.rstrip('/')}/{state['averages']}")
    return table_of_parts(costs, averages, dates)


def remove_unused(spark: SparkSession, root: str) -> int:
    """Delete folders that the current note does not name; returns how many versions went as a whole."""
    state = _state(spark, root)
    named = [known["folder"] for known in state["months"].values()] + [state.get("averages", "")]
    return remove_folders(spark, root, {name.split("/")[0] for name in named})


def stored_months(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each month, as noted."""
    return {month: known["folder"] for month, known in _state(spark, root)["months"].items()}

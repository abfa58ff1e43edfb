"""Daily roll-up of the facts that is kept between reports: a refresh reads only the days that can have changed.

The roll-up has one exact sum per day, environment label, organisation, pillar and product, partitioned by
day, and the columns of facts that the report's operators read, so a report over it equals one over the facts.
Days up to the cut-off of the last refresh are complete: a refresh recomputes the days after it and
those that late loads are known to have touched, and replaces their partitions alone. The note of
how far the roll-up is complete is written last, so a refresh that fails is repeated by the next one.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.plans.dates import DAY, DateRange, ReportDates, covering, within
from tallyfold.sources.versions import read_note, write_note

KEYS = ["environment", "cto", "tr_product_pillar_team", "tr_product_id", "tr_product"]


def _days(root: str) -> str:
    return f"{root.rstrip('/')}/days"


def _note(root: str) -> str:
    return f"{root.rstrip('/')}/_complete"


def report_spans(dates: ReportDates) -> list[DateRange]:
    """All days that any section of the report reads."""
    return covering([dates.average_span, *(span for pair in dates.comparisons for span in (pair.current, pair.previous))])


def due_days(spark: SparkSession, root: str, dates: ReportDates, late: Iterable[DateRange] = ()) -> list[DateRange]:
    """Days that a refresh has to read: those not complete at the last one, those before it began, late ones."""
    wanted = report_spans(dates)
    note = read_note(spark, _note(root))
    if note is None:
        return wanted
    first, complete = date.fromisoformat(note["first"]), date.fromisoformat(note["complete"])
    open_days = [DateRange(max(span.start, complete + DAY), span.end) for span in wanted]
    earlier = [DateRange(span.start, min(span.end, first - DAY)) for span in wanted]
    return covering([*open_days, *earlier, *late])


def due_facts(facts: DataFrame, due: Iterable[DateRange]) -> DataFrame:
    """Exact sums per day and keys of the days given; the test of the date reaches the scan."""
    return facts.filter(within(due)).groupBy("date", *KEYS).agg(F.expr("cast(sum(cost) as decimal(28, 4)) as cost"))


def refresh(facts: DataFrame, root: str, dates: ReportDates, late: Iterable[DateRange] = ()) -> list[DateRange]:
    """Bring the roll-up below ``root`` up to date and return the days that were read."""
    spark = facts.sparkSession
    due = due_days(spark, root, dates, late)
    if not due:
        return []
    # A day without facts is replaced too: each due day has one row that marks it and holds nothing.
    marks = spark.createDataFrame([(span.start, span.end) for span in due], "start date, end date")
    marks = marks.selectExpr("explode(sequence(start, end)) as date", "false as held")
    rows = due_facts(facts, due).withColumn("held", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    writer = rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(_days(root))
    note = read_note(spark, _note(root))
    first = min(due[0].start, date.fromisoformat(note["first"])) if note else due[0].start
    complete = max(dates.cutoff, date.fromisoformat(note["complete"])) if note else dates.cutoff
    write_note(spark, _note(root), {"first": first.isoformat(), "complete": complete.isoformat()})
    return due


def rolled_up(spark: SparkSession, root: str) -> DataFrame:
    """The roll-up, with the columns of facts that reports read."""
    texts = [T.StructField(name, T.StringType()) for name in KEYS]
    fields = [*texts, T.StructField("cost", T.DecimalType(28, 4)), T.StructField("held", T.BooleanType()), T.StructField("date", T.DateType())]
    return spark.read.schema(T.StructType(fields)).parquet(_days(root)).filter("held").select("date", *KEYS, "cost")

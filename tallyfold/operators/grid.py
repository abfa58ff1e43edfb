"""Calendar grid over product dimensions, and a repeatable sample of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.plans.dates import DateRange


def calendar_dimension_grid(
    dimensions: DataFrame, span: DateRange, environments: Sequence[str], clouds: Sequence[str]
) -> DataFrame:
    """One row per day, dimension row, environment and cloud.

    Every dimension row unfolds its own days and labels where it is stored: no join, no shuffle.
    """
    days = F.sequence(F.lit(span.start), F.lit(span.end))
    return (
        dimensions.withColumn("date", F.explode(days))
        .withColumn("environment", F.explode(F.array(*map(F.lit, environments))))
        .withColumn("cloud", F.explode(F.array(*map(F.lit, clouds))))
    )


def grid_sample(grid: DataFrame, keys: Sequence[str], percent: int = 30) -> DataFrame:
    """Keep about ``percent`` of the rows, always the same ones, chosen by a hash of their keys."""
    text = ", ".join(f"coalesce(cast({key} as string), '')" for key in keys)
    bucket = f"cast(conv(substring(md5(concat_ws('|', {text})), 1, 8), 16, 10) as bigint) % 100"
    return grid.filter(f"{bucket} < {percent}")

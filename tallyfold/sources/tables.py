"""Fact and average tables: read, conform, unify, replace, verify, publish as a view."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.plans.dates import DateRange, covering, within
from tallyfold.schemas import COST_FACTS
from tallyfold.sources.versions import commit_version, new_version, read_current


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table by path (its current version) or, without a slash in it, by catalog name; conformed to a schema if given."""
    table = read_current(spark, source) if "/" in source else spark.table(source)
    return conform_to_schema(table, schema) if schema else table


def _months_of(spans: Iterable[DateRange]) -> str:
    tests = [f"month between '{span.start:%Y-%m}' and '{span.end:%Y-%m}'" for span in covering(spans)]
    return " or ".join(tests) or "false"


def scan_cost_facts(
    spark: SparkSession,
    source: str,
    schema: T.StructType = COST_FACTS,
    spans: Iterable[DateRange] | None = None,
) -> DataFrame:
    """Facts of a stored table, limited to some date ranges if given.

    A table partitioned by date is pruned by any test of the date; for one partitioned by month
    the ranges are also turned into months, so only the files of those months are read.
    """
    table = read_table(spark, source)
    if spans is not None:
        spans = list(spans)
        if "month" in table.columns:
            table = table.filter(_months_of(spans))
        table = table.filter(within(spans))
    return conform_to_schema(table, schema)


def _conformed(frame: DataFrame, target: T.StructField) -> Column:
    if target.name not in frame.columns:
        return F.lit(None).cast(target.dataType).alias(target.name)
    column = F.col(target.name)
    if frame.schema[target.name].dataType == target.dataType:
        return column
    kept = column.try_cast(target.dataType)
    if isinstance(target.dataType, T.DecimalType):
        # Text that is no number becomes NULL; a number the type would change or lose is an error.
        given = column.try_cast("double")
        lost = given.isNotNull() & (kept.isNull() | (F.abs(kept.cast("double") - given) > F.abs(given) * 1e-9))
        text = F.concat(column.cast("string"), F.lit(f" does not fit {target.name} {target.dataType.simpleString()}"))
        kept = F.when(lost, F.raise_error(text).cast(target.dataType)).otherwise(kept)
    return kept.alias(target.name)


def conform_to_schema(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order and type.

    Text that cannot be read becomes NULL, as does a column the frame lacks. An amount that a decimal
    column would round or cannot hold is an error, never a silent loss: take ``COST_FACTS_FLOAT`` or
    a wider decimal for such facts. Columns that already fit are passed through, so filters on them
    still reach the file scan.
    """
    return frame.select([_conformed(frame, field) for field in schema.fields])


def union_sources(sources: Iterable[DataFrame], schema: T.StructType = COST_FACTS) -> DataFrame:
    """UNION ALL of several cost sources in the required schema."""
    return reduce(DataFrame.unionByName, [conform_to_schema(source, schema) for source in sources])


def replace_table(
    frame: DataFrame,
    path: str,
    partition: str | None = None,
    table: str | None = None,
    check: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """Replace the contents of a table and return it.

    The rows are written to a new version below ``path`` and become current in one step after ``check``
    has seen them (see ``versions``), so the frame may read the table itself and a load that fails
    leaves the old one. ``partition`` is ``date``, or ``month`` (a text column derived from ``date``)
    where a day is too little for a file. The rebalance hint brings the rows of a partition together
    and splits one that holds far more rows than others. ``table`` also names the version in the catalog.
    """
    spark = frame.sparkSession
    if partition == "month":
        frame = frame.withColumn("month", F.expr("date_format(date, 'yyyy-MM')"))
    if partition:
        frame = frame.hint("rebalance", partition)
    if partition == "month":
        # Days in order, so that a test of the date skips row groups of a month.
        frame = frame.sortWithinPartitions("month", "date")
    folder = new_version(path)
    writer = frame.write.format("parquet")
    if partition:
        writer = writer.partitionBy(partition)
    writer.save(folder)
    columns = [column for column in frame.columns if column != partition] + ([partition] if partition else [])
    schema = T.StructType([T.StructField(name, frame.schema[name].dataType) for name in columns])
    found = commit_version(spark.read.schema(schema).parquet(folder), path, folder, check)
    if table is None:
        return found
    # The files are there: only the name in the catalog is exchanged.
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=folder, source="parquet")
    if partition:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def verify_row_count(loaded: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: rows loaded, rows expected, whether they agree."""
    counts = loaded.selectExpr("count(*) as loaded_rows", "0L as expected_rows").unionByName(
        expected.selectExpr("0L as loaded_rows", "count(*) as expected_rows")
    )
    both = counts.selectExpr("sum(loaded_rows) as loaded_rows", "sum(expected_rows) as expected_rows")
    return both.selectExpr("*", "loaded_rows = expected_rows as row_counts_match")


def reconciled(loaded: DataFrame, expected: DataFrame, key: str = "date") -> DataFrame:
    """Values of ``key`` whose rows differ, whatever their order: rows and sums of row hashes of both sides.

    Each side becomes one row per value before they meet. Equal counts with unequal sums tell rows
    that were exchanged for others; sums of 64-bit hashes are exact decimals, so repeated rows count. Values are
    compared in the types of ``expected``.
    """
    columns = [name for name in expected.columns if name in loaded.columns]
    hashed = f"sum(cast(xxhash64({', '.join(f'`{name}`' for name in columns)}) as decimal(20, 0)))"

    def per_key(frame: DataFrame, side: str) -> DataFrame:
        counted = frame.groupBy(key).agg(F.expr("count(*) as n"), F.expr(f"{hashed} as hashed"))
        return counted.selectExpr(f"`{key}` as _{side}", f"n as {side}_rows", f"hashed as {side}_hash")

    alike = [F.col(f"`{name}`").cast(expected.schema[name].dataType).alias(name) for name in columns]
    one, two = per_key(loaded.select(alike), "loaded"), per_key(expected.select(columns), "expected")
    both = one.join(two, F.col("_loaded").eqNullSafe(F.col("_expected")), "full_outer")
    differing = both.filter("not (loaded_rows <=> expected_rows and loaded_hash <=> expected_hash)")
    return differing.selectExpr(
        f"coalesce(_loaded, _expected) as `{key}`",
        "coalesce(loaded_rows, 0L) as loaded_rows",
        "coalesce(expected_rows, 0L) as expected_rows",
        "coalesce(loaded_rows, 0L) = coalesce(expected_rows, 0L) as same_count",
    )


def publish_view(frame: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view and return it."""
    frame.createOrReplaceTempView(name)
    return frame.sparkSession.table(name)


def write_sections(sections: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Persist every report section under its name; returns the stored sections."""
    return {name: replace_table(section, f"{folder}/{name}") for name, section in sections.items()}

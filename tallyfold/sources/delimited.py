"""CSV files with and without a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.sources.tables import replace_table
from tallyfold.sources.versions import commit_version, current_version, new_version

# Quotes inside a quoted field are doubled, and no field is trimmed.
_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
}
# An empty field is NULL and a quoted empty field is an empty text. Spark takes both for NULL
# unless its mark of a NULL is something no field contains.
_READ = {**_FORMAT, "nullValue": "\u0000"}


def csv_write(frame: DataFrame, path: str, header: bool = True) -> None:
    frame.write.mode("overwrite").options(header=str(header).lower(), **_FORMAT).csv(path)


def csv_load_declared(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = False,
    strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read under a declared schema; ``strict`` fails on the first record that does not fit.

    ``multi_line`` is needed only for line breaks inside quoted fields; such files cannot be split.
    """
    options = dict(
        _READ,
        header=str(header).lower(),
        mode="FAILFAST" if strict else "PERMISSIVE",
        multiLine=str(multi_line).lower(),
    )
    return spark.read.schema(schema).options(**options).csv(path)


def csv_load_inferred(
    spark: SparkSession, path: str, names: list[str] | None = None, header: bool = False
) -> DataFrame:
    """Read with detected column types; ``names`` are given to the columns, as many as the file has."""
    frame = spark.read.options(**_READ, header=str(header).lower(), inferSchema="true").csv(path)
    if names and len(names) != len(frame.columns):
        raise ValueError(f"{path} has {len(frame.columns)} columns, not {len(names)}")
    return frame.toDF(*names) if names else frame


def csv_load_fitting(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read headerless CSV, keeping the declared type of every column whose values all fit it.

    A column that does not fit becomes a double if it holds numbers only, else text; declared texts
    stay texts. One pass over the file finds the types. A record of another width is an error.
    """
    texts = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    frame = csv_load_declared(spark, path, texts)
    kinds = {}
    for field in schema:
        if field.dataType != T.StringType():
            kinds[field.name] = [field.dataType.simpleString(), "double"] if isinstance(field.dataType, T.NumericType) else [field.dataType.simpleString()]

    def fits(name: str, kind: str) -> str:
        return f"coalesce(bool_and(`{name}` is null or try_cast(`{name}` as {kind}) is not null), true) as `{name} {kind}`"

    tests = [F.expr(fits(name, kind)) for name, some in kinds.items() for kind in some]
    found = frame.agg(*tests).first().asDict() if tests else {}
    chosen = {name: next((kind for kind in some if found[f"{name} {kind}"]), "string") for name, some in kinds.items()}
    return frame.selectExpr(*[f"cast(`{name}` as {chosen.get(name, 'string')}) as `{name}`" for name in schema.names])


_REASON, _RECORD, _FILE = "reject_reason", "reject_record", "reject_file"
REJECTS = T.StructType([T.StructField(name, T.StringType()) for name in (_REASON, _RECORD, _FILE)])


def csv_load_marked(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """Every record under the declared types, in one pass, with a reason where it does not fit.

    A record is rejected if it has another width, or a value that its column's type cannot hold or would change; the
    reason names the first such column. Rejected records carry their text and file, the others NULL.
    """
    texts = T.StructType([T.StructField(field.name, T.StringType()) for field in schema] + [T.StructField(_RECORD, T.StringType())])
    options = dict(_READ, header=str(header).lower(), mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD)
    raw = spark.read.schema(texts).options(**options).csv(path)
    tests = [f"when {_RECORD} is not null then 'width'"]
    for field in schema:
        kind, name = field.dataType.simpleString(), f"`{field.name}`"
        if kind == "string":
            continue
        lost = f"{name} is not null and try_cast({name} as {kind}) is null"
        if kind.startswith("decimal"):
            lost = f"({lost}) or abs(double(try_cast({name} as {kind})) - try_cast({name} as double)) > abs(try_cast({name} as double)) * 1e-9"
        tests.append(f"when {lost} then '{field.name}'")
    record = f"coalesce({_RECORD}, to_csv(struct({', '.join(f'`{name}`' for name in schema.names)})))"
    marked = raw.selectExpr("*", f"case {' '.join(tests)} end as {_REASON}", f"_metadata.file_path as {_FILE}")
    typed = [f"if({_REASON} is null, try_cast(`{field.name}` as {field.dataType.simpleString()}), null) as `{field.name}`" for field in schema]
    aside = [f"if({_REASON} is null, null, {value}) as {name}" for name, value in ((_RECORD, record), (_FILE, _FILE))]
    return marked.selectExpr(*typed, _REASON, *aside)


def csv_load_table(
    spark: SparkSession, path: str, schema: T.StructType, target: str, tolerance: float = 1e-4
) -> DataFrame:
    """Load headerless CSV into a table under the declared schema; see ``read_rejects`` for what did not fit.

    One pass writes good rows and rejects side by side into a new version of the table. If at most
    ``tolerance`` of the records are rejects, that version becomes current. If there are more, the columns themselves
    differ, and the file is loaded with other types for those that do not fit, without rejects. A load that
    fails leaves the table as it was.
    """
    folder = new_version(target)
    marked = csv_load_marked(spark, path, schema)
    marked.withColumn("kind", F.expr(f"if({_REASON} is null, 'row', 'reject')")).write.partitionBy("kind").parquet(folder)
    full = T.StructType([*schema.fields, *REJECTS.fields, T.StructField("kind", T.StringType())])
    counted = {row["kind"]: row["n"] for row in spark.read.schema(full).parquet(folder).groupBy("kind").agg(F.expr("count(*) as n")).collect()}
    rows, rejects = counted.get("row", 0), counted.get("reject", 0)
    if rejects > tolerance * (rows + rejects):
        return replace_table(csv_load_fitting(spark, path, schema), target)
    if not rows:
        return replace_table(spark.createDataFrame([], schema), target)
    stored = spark.read.schema(schema).parquet(f"{folder}/kind=row")
    return commit_version(stored, target, f"{folder}/kind=row", rows=rows, rejects=rejects)


def read_rejects(spark: SparkSession, target: str) -> DataFrame:
    """Records that the current version of a loaded table left out: reason, text, file."""
    known = current_version(spark, target)
    if not known or not known.get("rejects"):
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(f"{target.rstrip('/')}/{known['folder'].removesuffix('kind=row')}kind=reject")

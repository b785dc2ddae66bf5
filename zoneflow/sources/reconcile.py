"""Scans of files whose column names and types changed over time.

One scan with one schema fails where a column is BIGINT in one month and DOUBLE in the next, or is spelt differently. Here files
are grouped by the schema in their footers, each group is scanned with its own schema, so pruning and pushdown reach it,
its columns are matched by name without regard to case and cast, and the groups are united by name. There are as many scans as
there were different schemas, not files.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from zoneflow.schemas import TRIP_SCHEMA
from zoneflow.sources.files import NoInputError

#: Footers read at once.
READERS = 8
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


@dataclass(frozen=True)
class FileGroup:
    """Files that share one schema."""

    schema: T.StructType
    paths: tuple[str, ...]


def parquet_paths(spark: SparkSession, base: str, pattern: str) -> list[str]:
    """What ``base/pattern`` matches, sorted: files, or folders that a writer made of one. Only names are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def file_groups(spark: SparkSession, base: str, pattern: str) -> list[FileGroup]:
    """Files by schema, in the order of their first file. One footer of each is read, some at a time."""
    paths = parquet_paths(spark, base, pattern)
    if not paths:
        raise NoInputError(f"no parquet input matches {base}/{pattern}")

    def schema_of(path: str) -> T.StructType | None:
        try:
            found = spark.read.parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without data files
                return None
            raise
        return T.StructType([T.StructField(f.name, f.dataType) for f in found])

    with ThreadPoolExecutor(READERS) as pool:
        schemas = list(pool.map(inheritable_thread_target(spark)(schema_of), paths))
    groups: dict[str, FileGroup] = {}
    for path, schema in zip(paths, schemas):
        if schema is None:
            continue
        key = schema.json()
        groups[key] = FileGroup(schema, (*(groups[key].paths if key in groups else ()), path))
    return list(groups.values())


def converted(column: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """``column`` as ``wanted``; what has no such value is NULL.

    A number with a fraction is no whole number. A time stamp with a zone is read as its time in UTC, whatever the session's zone.
    """
    if found == wanted:
        return column
    if isinstance(found, T.TimestampType) and isinstance(wanted, T.TimestampNTZType):
        seconds = F.unix_micros(column).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
        return F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    if isinstance(wanted, (T.LongType, T.IntegerType)):
        if isinstance(found, T.StringType):
            column, found = column.try_cast("decimal(38,10)"), T.DecimalType(38, 10)
        if isinstance(found, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.when(column == F.floor(column), column)
    return column.try_cast(wanted)


def matched(schema: T.StructType, name: str) -> T.StructField | None:
    """The field of that name, or else the one that differs in case only."""
    exact = [f for f in schema if f.name == name]
    alike = [f for f in schema if f.name.lower() == name.lower()]
    return (exact or alike or [None])[0]


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """One type that holds all: equal ones stay, whole numbers become BIGINT, numbers DOUBLE, times TIMESTAMP_NTZ, all else text."""
    own = list(dict.fromkeys(types))
    if len(own) == 1:
        return own[0]
    if all(isinstance(t, T.IntegralType) for t in own):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in own):
        return T.DoubleType()
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in own):
        return T.TimestampNTZType()
    return T.StringType()


def union_schema(groups: list[FileGroup], declared: T.StructType | None) -> T.StructType:
    """The declared columns, then all others in the order in which they first occur, of their common type."""
    fields = {f.name.lower(): f for f in declared or []}
    types: dict[str, list[T.DataType]] = {}
    for group in groups:
        for f in group.schema:
            if f.name.lower() not in fields or f.name.lower() in types:
                types.setdefault(f.name.lower(), []).append(f.dataType)
                fields.setdefault(f.name.lower(), f)
    return T.StructType([T.StructField(f.name, common_type(types[k]) if k in types else f.dataType) for k, f in fields.items()])


def scan_reconciled(spark: SparkSession, base: str, pattern: str, schema: T.StructType | None, keep_others: bool = False) -> DataFrame:
    """All files that match, as one table of ``schema``; with ``keep_others``, or without a schema, their other columns too.

    A column that a file lacks is NULL for its rows.
    """
    groups = file_groups(spark, base, pattern)
    wanted = union_schema(groups, schema) if keep_others or schema is None else schema
    result = None
    for group in groups:
        columns = []
        for field in wanted:
            found = matched(group.schema, field.name)
            value = F.lit(None).cast(field.dataType) if found is None else converted(F.col(f"`{found.name}`"), found.dataType, field.dataType)
            columns.append(value.alias(field.name))
        part = spark.read.schema(group.schema).parquet(*group.paths).select(*columns)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], wanted) if result is None else result


def scan_trips_reconciled(spark: SparkSession, base: str, schema: T.StructType | None = TRIP_SCHEMA, keep_others: bool = False) -> DataFrame:
    """All monthly trip files, whatever their months' types and spellings."""
    return scan_reconciled(spark, base, "*tripdata*.parquet", schema, keep_others)


def schema_drift(spark: SparkSession, base: str, pattern: str = "*tripdata*.parquet", schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """Where files differ from the schema: file, column, found_name, found_type, wanted_type, change (missing, renamed, retyped,
    renamed and retyped, or added)."""
    rows = []
    for group in file_groups(spark, base, pattern):
        for field in schema:
            found = matched(group.schema, field.name)
            changes = ["missing"] if found is None else [
                *(["renamed"] if found.name != field.name else []), *(["retyped"] if found.dataType != field.dataType else [])]
            if changes:
                rows += [(p.rsplit("/", 1)[-1], field.name, found and found.name, found and found.dataType.simpleString(),
                          field.dataType.simpleString(), " and ".join(changes)) for p in group.paths]
        known = {f.name.lower() for f in schema}
        rows += [(p.rsplit("/", 1)[-1], None, f.name, f.dataType.simpleString(), None, "added")
                 for f in group.schema if f.name.lower() not in known for p in group.paths]
    return spark.createDataFrame(rows, "file string, column string, found_name string, found_type string, wanted_type string, change string")

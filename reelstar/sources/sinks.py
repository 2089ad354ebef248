"""Sinks: Parquet, managed tables, CSV export, DDL and partitioned writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelstar.sources.files import read_csv


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """Parquet files at ``path`` (overwrite by default); optional Hive-style
    partition folders, which later reads prune by filter."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, name: str, fmt: str = "parquet",
                 partition_by: Sequence[str] | None = None, options: dict | None = None) -> None:
    """Append to a catalog table; ``fmt`` lets a warehouse connector be supplied."""
    writer = df.write.mode("append").format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def materialize(df: DataFrame, name: str, fmt: str = "parquet",
                sort_within: Sequence[str] | None = None,
                bucket_by: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """Store a mart as a table (overwrite) and return the stored table.

    A stored table has no row order; ``sort_within`` sorts inside each file
    so that min/max statistics skip row groups on that column.  ``bucket_by``
    = (n, cols) stores the table hash-bucketed so that later joins and
    aggregations on those columns need no shuffle.
    """
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode("overwrite").format(fmt)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols)
        if sort_within:
            writer = writer.sortBy(*sort_within)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
               rows_per_file: int = 0) -> None:
    """Uncompressed CSV with a header row, quoted as ``csv_to_table`` reads it:
    quotes are doubled, blanks kept, an empty text is ``""`` and a null nothing.
    A row of one null column would be a blank line, which no reader returns.
    ``rows_per_file`` bounds the files, so that a later load can be bounded."""
    (df.write.mode(mode).partitionBy(*partition_by).option("header", True).option("compression", "none").option("escape", '"')
     .option("lineSep", "\n").option("ignoreLeadingWhiteSpace", False).option("maxRecordsPerFile", rows_per_file)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def csv_to_table(spark: SparkSession, paths, schema: T.StructType, name: str,
                 fmt: str = "parquet", multiline: bool = True, path: str | None = None) -> DataFrame:
    """Load CSV (header skipped) into a table, creating or truncating it.

    Quoted texts may hold newlines; ``multiline=False`` lets the large files
    of a feed without such texts be split.  ``path`` is the table's folder where
    it is not the warehouse's.
    """
    writer = read_csv(spark, paths, schema, multiline=multiline, keep_empty=True).write.mode("overwrite").format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def ddl_type(dt: T.DataType) -> str:
    return dt.simpleString()


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType,
                           fmt: str = "parquet", database: str | None = None) -> None:
    """CREATE SCHEMA / CREATE TABLE IF NOT EXISTS with typed columns."""
    if database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    cols = ", ".join(f"`{f.name}` {ddl_type(f.dataType)}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}")

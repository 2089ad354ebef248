"""Ledger of processed files: an append-only table of (path, processed_at).

The ledger is only ever appended to, after the data it describes has been
committed, so a failure between the two steps leaves the file unmarked and
the retry re-processes it into the same (overwritten) batch location.  The
manifest (path, batch) beside it fixes which files share a batch before any
data is written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.schemas import LEDGER

MANIFEST = "path string, batch string"


def create_table(spark: SparkSession, location: str, schema, partition_by: str | None = None) -> None:
    """An empty Parquet table at ``location`` if there is none."""
    try:
        spark.read.schema(schema).parquet(location)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        writer = spark.createDataFrame([], schema).write.mode("append")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(location)


def create_ledger(spark: SparkSession, location: str) -> None:
    """Create the ledger table at ``location`` if it does not exist."""
    create_table(spark, location, LEDGER)


def read_manifest(spark: SparkSession, location: str) -> DataFrame:
    """Files dealt to batches so far: (path, batch)."""
    create_table(spark, location, MANIFEST)
    return spark.read.schema(MANIFEST).parquet(location)


def read_ledger(spark: SparkSession, location: str) -> DataFrame:
    """Processed paths as a set (duplicates from retried appends collapse)."""
    create_ledger(spark, location)
    return spark.read.schema(LEDGER).parquet(location).select("path").distinct()


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold (anti-join on path)."""
    return listing.join(ledger.select("path"), "path", "left_anti")


def merge(ledger: DataFrame, added: DataFrame) -> DataFrame:
    """Set union of the ledger and newly processed paths."""
    return ledger.select("path").unionByName(added.select("path")).dropDuplicates(["path"])


def mark_processed(spark: SparkSession, location: str, paths: DataFrame) -> None:
    """Append paths to the ledger (call only after the data write committed)."""
    (paths.select("path").withColumn("processed_at", F.current_timestamp())
     .write.mode("append").parquet(location))

"""Serial ids that survive appends.

A table of reservations holds one row per batch: the first id and the number of
rows it was given.  A batch reserves the ids above the highest mark before its
rows are written into its own folder, so ids given out never change, ranges do
not overlap, and a batch that died is written again with the ids it reserved.
One writer appends to a table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.operators.clean import dense_serial_id
from reelstar.sources.ledger import create_table
from reelstar.streaming.ingest import InjectedFailure

RESERVATIONS = "batch string, first_id bigint, n_rows bigint"


def reservations(spark: SparkSession, path: str) -> DataFrame:
    """The ranges given out so far: (batch, first_id, n_rows); a hidden table beside the data."""
    location = f"{path.rstrip('/')}/_reservations"
    create_table(spark, location, RESERVATIONS)
    return spark.read.schema(RESERVATIONS).parquet(location)


def reserve(spark: SparkSession, path: str, batch: str, n: int) -> int:
    """First id of ``batch``: its own if it has a range, else above the high-water mark.

    A batch that comes back with another number of rows is not the same batch: ValueError.
    """
    held = reservations(spark, path)
    own = held.where(F.col("batch") == batch).first()
    if own is not None:
        if own["n_rows"] != n:
            raise ValueError(f"batch {batch} reserved {own['n_rows']} ids and now has {n} rows")
        return own["first_id"]
    first = held.agg(F.coalesce(F.max(F.col("first_id") + F.col("n_rows")), F.lit(1))).first()[0]
    spark.createDataFrame([(batch, first, n)], RESERVATIONS).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_reservations")
    return first


def append_with_ids(rows: DataFrame, path: str, batch: str, order: Sequence[str], name: str = "id",
                    fail_before_write: bool = False) -> int:
    """Append ``rows`` to the table at ``path`` with dense ids in the order of ``order``.

    Numbering inside the batch is distributed (``dense_serial_id``); only the
    batch's size and its first id pass through the driver.  Writing the same
    batch again replaces its folder with the same rows and ids.  Returns the
    number of rows.
    """
    spark = rows.sparkSession
    numbered = dense_serial_id(rows, order, name)
    n = numbered.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    first = reserve(spark, path, batch, n)
    if fail_before_write:
        raise InjectedFailure("stopped after the reservation, before the rows were written")
    shifted = numbered.withColumn(name, F.col(name) + F.lit(first - 1))
    shifted.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")
    return n


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows written so far, with their ``batch``."""
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")

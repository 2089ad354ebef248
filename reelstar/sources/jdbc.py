"""Relational database hop: batched inserts and a partitioned full-table read.

Both run on the executors: each task opens its own connection, the write in
batches of ``batch_size`` rows, the read over ``partitions`` ranges of a
numeric column (bounds found with one small aggregate query).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batch_size: int = 10_000, properties: dict | None = None,
               write_partitions: int | None = None) -> None:
    """Batched insert of ``df`` into ``table``; ``write_partitions`` caps the
    number of concurrent connections."""
    out = df.coalesce(write_partitions) if write_partitions else df
    props = {"batchsize": str(batch_size), **(properties or {})}
    out.write.jdbc(url, table, mode=mode, properties=props)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None,
              partitions: int = 8, properties: dict | None = None,
              quote: bool = True) -> DataFrame:
    """Full-table extract; split over ``partitions`` ranges of ``column``
    (quoted as Spark's writer created it unless ``quote`` is off)."""
    props = dict(properties or {})
    if column is None:
        return spark.read.jdbc(url, table, properties=props)
    quoted = f'"{column}"' if quote else column
    bounds = spark.read.jdbc(
        url, f"(SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi FROM {table}) b",
        properties=props).first()
    lo, hi = bounds[0], bounds[1]
    if lo is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=column, lowerBound=int(lo), upperBound=int(hi) + 1,
                           numPartitions=partitions, properties=props)

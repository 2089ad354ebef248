"""Clustered storage: rows laid out along a Z-order curve of several columns.

Files and row groups then hold narrow ranges of every one of these columns, so a
filter on any of them skips most of the data by its minima and maxima.  A
plain sort serves its first column only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6          # of a column's rank: 63 boundaries
ACCURACY = 1000   # of the boundaries: ranks are right to a 1000th of the rows


def boundaries(df: DataFrame, by: Sequence[str], bits: int = BITS) -> list[list]:
    """Per column its ``2 ** bits - 1`` quantiles, from one aggregation with partial sketches.

    Numbers, dates and timestamps; a column without a value has none.
    """
    for c in by:
        if not isinstance(df.schema[c].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ValueError(f"column {c} has no quantiles")
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(F.col(c), shares, ACCURACY).alias(f"q{k}") for k, c in enumerate(by)]).first()
    return [sorted(set(q or [])) for q in row]


def rank(column: Column, bounds: list) -> Column:
    """How many boundaries the value reaches; 0 for a null."""
    if not bounds:
        return F.lit(0)
    reached = F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= column)
    return F.when(column.isNull(), 0).otherwise(F.size(reached))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits taken in turn, highest first."""
    if bits * len(ranks) > 62:
        raise ValueError("more than 62 bits")
    out = F.lit(0).cast("bigint")
    for k in range(bits):
        for j, r in enumerate(ranks):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, k).bitwiseAND(F.lit(1)).cast("bigint"), k * len(ranks) + j))
    return out


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int | None = None, partition_by: Sequence[str] = (),
                    bits: int = BITS, rows_per_file: int = 0) -> None:
    """Parquet files in Z-order of ``by``, ``files`` ranges (default: Spark's shuffle partitions).

    With ``partition_by`` only the folders that ``df`` has rows of are replaced,
    without it the whole path.  Rows that are equal in ``by`` are told apart by a
    row number, so a value that a third of the rows share spreads over its share
    of the files.  ``df`` is read for the boundaries, for Spark's range samples and
    for the write, so store it first if it is dear.
    """
    bounds = boundaries(df, by, bits)
    curve = interleaved([rank(F.col(c), b) for c, b in zip(by, bounds)], bits)
    placed = df.withColumn("_z", curve).withColumn("_row", F.monotonically_increasing_id())
    order = [*partition_by, "_z", *by, "_row"]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    writer = (ranged.sortWithinPartitions(*order).drop("_z", "_row").write.mode("overwrite")
              .option("maxRecordsPerFile", rows_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)

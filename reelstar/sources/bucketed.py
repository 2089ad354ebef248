"""Insert-ignore into a bucketed table: the target is never shuffled.

The target is stored hash-bucketed by its key.  A batch is reduced to its first
row per key, partitioned like the buckets and anti-joined with them bucket by
bucket, so that a load moves the batch alone, whatever the target holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.operators.clean import PURCHASE_KEY, first_per_key
from reelstar.session import cut_lineage


def buckets_of(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number and columns of a table's buckets (0 and none of a plain table)."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    columns = facts.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return int(facts.get("Num Buckets", "0")), [c.strip() for c in columns.split(",") if c.strip()]


def _append(rows: DataFrame, name: str, n: int, key: Sequence[str], path: str | None = None) -> None:
    writer = rows.repartition(n, *key).write.mode("append").format("parquet").bucketBy(n, *key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create(rows: DataFrame, name: str, key: Sequence[str] = PURCHASE_KEY, buckets: int | None = None, path: str | None = None,
           order: Sequence[str] = ("invoice_date", "quantity", "unit_price")) -> DataFrame:
    """A table of the first row per key, in ``buckets`` files by the key (default: as many as
    shuffle partitions); ``rows`` may be empty."""
    n = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _append(first_per_key(rows, key, order), name, n, key, path)
    return rows.sparkSession.table(name)


def new_rows(incoming: DataFrame, name: str, order: Sequence[str] = ("invoice_date", "quantity", "unit_price")) -> DataFrame:
    """The first row of each key of ``incoming`` that the table ``name`` lacks.

    A null in a key equals a null.  The batch is reduced before it meets the
    table, so a hot key is one row; it is exchanged to the table's buckets, by
    the reduction itself if these are as many as shuffle partitions.  The
    reduction is observed, or the optimizer would join first.  If the table holds
    rows with a null in their key, the reduced batch is written to the checkpoint
    folder, and its rows of that kind meet the table's rows of that kind alone.
    """
    spark = incoming.sparkSession
    n, key = buckets_of(spark, name)
    if not n:
        raise ValueError(f"{name} has no buckets")
    firsts = first_per_key(incoming, key, order)
    held = spark.table(name).select(*key)
    broken = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    kept = held.where(~broken).hint("merge")
    if held.where(broken).isEmpty():   # a key with a null equals none of the table's
        observed = firsts.observe(f"firsts_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("keys"))
        return observed.repartition(n, *key).join(kept, list(key), "left_anti").select(*incoming.columns)
    firsts = cut_lineage(firsts)
    whole = firsts.where(~broken).repartition(n, *key).join(kept, list(key), "left_anti")
    left, right = firsts.where(broken).alias("i"), held.where(broken).alias("t")
    same = reduce(Column.__and__, [F.col(f"i.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key])
    return whole.select(*incoming.columns).unionByName(left.join(right, same, "left_anti").select(*incoming.columns))


def insert_ignore(incoming: DataFrame, name: str, order: Sequence[str] = ("invoice_date", "quantity", "unit_price")) -> None:
    """Appends ``new_rows`` to the table; a batch appended again adds nothing, so a load that died is run again.

    One writer at a time; columns are those of the table.
    """
    spark = incoming.sparkSession
    n, key = buckets_of(spark, name)
    _append(new_rows(incoming.select(*spark.table(name).columns), name, order), name, n, key)
    spark.catalog.refreshTable(name)

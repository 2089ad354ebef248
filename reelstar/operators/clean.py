"""Cleaning of the purchase feed, insert-ignore and serial ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.functions import parse_invoice_ts
from reelstar.schemas import PURCHASE_RENAMES
from reelstar.session import cut_lineage, store

PURCHASE_KEY = ("invoice_number", "stock_code")
SERIAL_CHUNK = 1 << 16


def drop_missing_customer(raw: DataFrame, column: str = "CustomerID") -> DataFrame:
    """Rows without a customer are dropped before anything else."""
    return raw.dropna(subset=[column])


def fill_missing_text(df: DataFrame) -> DataFrame:
    """Missing text becomes ''; numeric nulls stay null (Spark's fillna meaning)."""
    return df.fillna("")


def rename_purchase_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(PURCHASE_RENAMES)


def cast_purchase_columns(df: DataFrame) -> DataFrame:
    """Typed purchase columns in one projection.

    The id arrives as double text (``17850.0``) and goes double -> bigint;
    the date is parsed with its format and is null when malformed.
    """
    return df.select(
        F.col("invoice_number").cast("string").alias("invoice_number"),
        F.col("stock_code").cast("string").alias("stock_code"),
        F.col("detail").cast("string").alias("detail"),
        F.col("quantity").cast("bigint").alias("quantity"),
        parse_invoice_ts("invoice_date").alias("invoice_date"),
        F.col("unit_price").cast(T.DecimalType(8, 3)).alias("unit_price"),
        F.col("customer_id").cast("double").cast("bigint").alias("customer_id"),
        F.col("country").cast("string").alias("country"),
    )


def clean_user_purchase(raw: DataFrame) -> DataFrame:
    """drop missing customer -> fill text -> rename -> cast."""
    return cast_purchase_columns(rename_purchase_columns(fill_missing_text(drop_missing_customer(raw))))


def cleaning_metrics(raw: DataFrame) -> DataFrame:
    """Rows read, rows dropped for a missing customer, text values filled and
    rows kept, computed in a single aggregation pass."""
    kept = F.col("CustomerID").isNotNull()
    text_cols = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    filled = sum((F.count_if(kept & F.col(c).isNull()) for c in text_cols), F.lit(0).cast("bigint"))
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~kept).alias("dropped_missing_customer"),
        filled.cast("bigint").alias("filled_values"),
        F.count_if(kept).alias("rows_out"),
    )


def clean_observed(raw: DataFrame, name: str = "cleaning") -> tuple[DataFrame, Observation]:
    """Cleaned purchases plus an ``Observation`` whose metrics (rows read,
    dropped, filled, kept) are filled in by whatever action runs the plan --
    the write itself, no second pass over the data."""
    obs = Observation(name)
    kept = F.col("CustomerID").isNotNull()
    text_cols = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    filled = sum((F.count_if(kept & F.col(c).isNull()) for c in text_cols), F.lit(0).cast("bigint"))
    observed = raw.observe(
        obs,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~kept).alias("dropped_missing_customer"),
        filled.cast("bigint").alias("filled_values"),
        F.count_if(kept).alias("rows_out"),
    )
    return clean_user_purchase(observed), obs


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order`` and then by the remaining columns.

    Written as ``min(struct(order..., rest...))`` so that the choice is a
    hash aggregation with map-side partial results: a key that holds a third
    of the rows is reduced in every task before the shuffle, instead of being
    sorted whole in one task as a ``row_number`` window would do.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    picked = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*key, *[F.col(f"_first.{c}").alias(c) for c in (*order, *rest)]).select(*df.columns)


def insert_new(incoming: DataFrame, target_keys: DataFrame, key: Sequence[str] = PURCHASE_KEY,
               order: Sequence[str] = ("invoice_date", "quantity", "unit_price")) -> DataFrame:
    """Insert-ignore: the rows to append so that the target gains each new key once.

    Incoming duplicates are reduced to the first row per key, then keys the
    target already holds are removed with an anti-join.
    """
    firsts = first_per_key(incoming, key, order)
    return firsts.join(target_keys.select(*key), list(key), "left_anti")


def dense_serial_id(df: DataFrame, order: Sequence[str], name: str = "id",
                    chunk: int = SERIAL_CHUNK) -> DataFrame:
    """Dense 1-based id following ``order`` (a deterministic SERIAL).

    A global ``row_number()`` would pull every row into one task, and a plain
    range sort cannot split a sort key shared by a third of the rows.  So:

    1. the rows are stored once in the shared checkpoint folder, where a row's
       place is the same in every pass over them and after an executor loss;
    2. they are range-sorted across partitions, ties broken by every column and
       then by that place in steps of ``chunk``, so that a hot row is many distinct
       sort keys (equal rows are alike, whichever comes first), and materialised to the
       reliable checkpoint folder so that both passes below see the same
       partitions;
    3. per-partition counts -- one row per partition, a size bound known up
       front -- give each partition its offset, broadcast to the rows.
    """
    cols = df.columns
    rest = [c for c in cols if c not in order]
    place = F.floor(F.monotonically_increasing_id() / chunk)
    sorted_df = cut_lineage(store(df, "unnumbered").withColumn("_place", place).orderBy(*order, *rest, "_place").select(*cols))
    with_pos = sorted_df.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_mono"),
    )
    counts = with_pos.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    local_pos = F.col("_mono") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return with_pos.join(F.broadcast(offsets), "_part").select(
        (F.col("_off") + local_pos + 1).alias(name), *cols)

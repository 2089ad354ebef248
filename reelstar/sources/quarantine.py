"""CSV loads that keep what they cannot use.

One pass over the files and one write: every row goes to the folder of its
outcome, good rows with their typed columns, rejected rows with the reason,
their file and their text.  Rows read are rows kept, rejected and dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.functions import parse_invoice_ts
from reelstar.sources.files import read_csv

KEPT, REJECTED, DROPPED = "kept", "rejected", "dropped"
RAW = "_raw_text"
MALFORMED = "malformed field"

def purchase_rules() -> tuple[dict[str, Column], dict[str, Column]]:
    """(drops, rejects) of the purchase feed: reason -> condition over the typed row."""
    return ({"missing customer": F.col("CustomerID").isNull()},
            {"bad invoice date": F.col("InvoiceDate").isNotNull() & parse_invoice_ts("InvoiceDate").isNull()})


def load(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, path: str, drops: Mapping[str, Column],
         rejects: Mapping[str, Column], multiline: bool = False) -> None:
    """Read CSV files and write every row below ``path`` by its outcome (overwritten).

    A row with a field that does not fit the schema is rejected first; then the
    first condition that holds decides, drops before rejects; all others are
    kept.  A null condition does not hold.
    """
    rows = read_csv(spark, paths, schema, multiline=multiline, with_source=True, corrupt_col=RAW)
    reason, outcome = F.when(F.col(RAW).isNotNull(), MALFORMED), F.when(F.col(RAW).isNotNull(), REJECTED)
    for kind, conditions in ((DROPPED, drops), (REJECTED, rejects)):
        for name, holds in conditions.items():
            reason, outcome = reason.when(holds, name), outcome.when(holds, kind)
    text = F.coalesce(F.col(RAW), F.to_csv(F.struct(*schema.names)))
    told = rows.select(*schema.names, "source_file", reason.alias("reason"), outcome.otherwise(KEPT).alias("outcome"), text.alias("text"))
    # the text is stored only where it is needed
    stored = told.withColumn("text", F.when(F.col("outcome") == REJECTED, F.col("text")))
    stored.write.mode("overwrite").partitionBy("outcome").parquet(path)


def _stored(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    extra = [T.StructField(c, T.StringType()) for c in ("source_file", "reason", "text", "outcome")]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(path)


def kept(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The good rows; the other folders are not read."""
    return _stored(spark, schema, path).where(F.col("outcome") == KEPT).select(*schema.names)


def rejected(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """``reason, source_file, text`` and the fields that could be read of the rejected rows."""
    return _stored(spark, schema, path).where(F.col("outcome") == REJECTED).select("reason", "source_file", "text", *schema.names)


def outcomes(spark: SparkSession, schema: T.StructType, path: str, *sums: str) -> DataFrame:
    """``outcome, reason, n_rows`` (reason '' if kept) and the sums of some columns; and the whole as outcome ``read``."""
    rows = _stored(spark, schema, path)
    totals = [F.count(F.lit(1)).alias("n_rows"), *(F.sum(c).cast("bigint").alias(c) for c in sums)]
    per = rows.groupBy("outcome", F.coalesce("reason", F.lit("")).alias("reason")).agg(*totals)
    whole = per.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), *(F.sum(c).cast("bigint").alias(c) for c in sums))
    return per.unionByName(whole.select(F.lit("read").alias("outcome"), F.lit("").alias("reason"), "*"))

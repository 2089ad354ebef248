"""Staging: the three source tables as the marts read them."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.functions import all_not_null, array_to_text, sentiment_flag, xml_tag
from reelstar.schemas import BROWSER_TAG, LOG_TAGS

STG_PURCHASE_REQUIRED = ("invoice_number", "stock_code", "quantity", "invoice_date",
                         "unit_price", "customer_id", "country")


def stg_user_purchase(clean: DataFrame) -> DataFrame:
    """Seven-column not-null filter, then the staging casts under their own names.

    The filter reaches the Parquet/CSV scan as ``IsNotNull`` pushdown.
    """
    return clean.where(all_not_null(STG_PURCHASE_REQUIRED)).select(
        "invoice_number", "stock_code", "detail",
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"),
        F.col("unit_price").cast("decimal(8,3)").alias("unit_price"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "country",
    )


def parse_review_logs(raw_logs: DataFrame, log_col: str = "logs",
                      with_browser: bool = False) -> DataFrame:
    """XML fragment -> one column per tag (first match, '' when absent)."""
    tags = dict(LOG_TAGS)
    if with_browser:
        tags[BROWSER_TAG[0]] = BROWSER_TAG[1]
    return raw_logs.select(
        F.col("id_review").cast("bigint").alias("log_id"),
        *[xml_tag(log_col, tag).alias(name) for tag, name in tags.items()],
    )


def stg_review_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("log_id").isNotNull())


def classify_output_to_flag(df: DataFrame, annotation_col: str = "sentiment",
                            negative: str = "negative") -> DataFrame:
    """Annotation array -> comma text -> 0/1 flag (only exact ``negative`` is 0)."""
    return (df.withColumn(annotation_col, array_to_text(annotation_col))
              .withColumn("positive_review", sentiment_flag(annotation_col, negative)))


def classified_movie_review(scored: DataFrame, batch_ts: Column | _dt.datetime | None = None,
                            annotation_col: str = "sentiment") -> DataFrame:
    """Classified-review job after scoring: flag, rename, stamp, select.

    ``batch_ts`` is the load time; the default keeps a per-row
    ``insert_date`` already present on the input, otherwise the current time.
    Pass a fixed value for reproducible loads.
    """
    flagged = classify_output_to_flag(scored, annotation_col)
    if batch_ts is None:
        stamp = F.col("insert_date") if "insert_date" in scored.columns else F.current_timestamp()
    elif isinstance(batch_ts, Column):
        stamp = batch_ts
    else:
        stamp = F.lit(batch_ts)
    return flagged.withColumnsRenamed({"cid": "user_id", "id_review": "review_id"}).select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("positive_review").cast("int").alias("positive_review"),
        F.col("review_id").cast("bigint").alias("review_id"),
        stamp.cast("timestamp_ntz").alias("insert_date"),
    )


def stg_classified_movie_review(classified: DataFrame) -> DataFrame:
    """Staging view over the classified reviews (registered as a temp view too)."""
    classified.createOrReplaceTempView("stg_classified_movie_review")
    return classified.sparkSession.table("stg_classified_movie_review")

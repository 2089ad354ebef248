"""Analytic queries (Q1-Q8) and metrics (M1-M8) over the star schema.

Every function takes the marts as DataFrames.  Money leaves as double after
an exact decimal sum; ratios are one double division of exact totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.functions import money

# The three states of the first example query, in test-data form.
Q1_STATES = ("NATION_1", "NATION_2", "NATION_3")
TOP_SPENDERS = 10


def _with_location(fact: DataFrame, dim_location: DataFrame, name: str = "state") -> DataFrame:
    loc = dim_location.select("id_dim_location", F.col("location").alias(name))
    return fact.join(loc, "id_dim_location")


def _with_device(fact: DataFrame, dim_devices: DataFrame) -> DataFrame:
    return fact.join(dim_devices.select("id_dim_devices", "device"), "id_dim_devices")


def q1_reviews_by_state_device(fact, dim_location, dim_devices,
                               states: Sequence[str] = Q1_STATES) -> DataFrame:
    """Fact rows (``count(review_count)``) per state and device, for three states.

    The IN filter is applied to the location dim before the join, so only
    matching dim rows are shuffled or broadcast.
    """
    loc = dim_location.where(F.col("location").isin(list(states)))
    joined = _with_device(_with_location(fact, loc), dim_devices)
    return (joined.groupBy("state", "device")
            .agg(F.count("review_count").alias("total_reviews"))
            .orderBy(F.desc("total_reviews"), "state", "device"))


def q2_positive_by_location(fact, dim_location) -> DataFrame:
    return (_with_location(fact, dim_location).groupBy("state")
            .agg(F.sum("review_score").cast("bigint").alias("positive_reviews"))
            .orderBy(F.desc("positive_reviews"), "state"))


def q3_revenue_sentiment(fact) -> DataFrame:
    return (fact.groupBy("customer_id")
            .agg(money(F.sum("amount_spent")).alias("total_spent"),
                 F.sum("review_score").cast("bigint").alias("total_positive_reviews"))
            .orderBy(F.desc("total_spent"), "customer_id"))


def q5_device_by_region(fact, dim_location, dim_devices) -> DataFrame:
    joined = _with_device(_with_location(fact, dim_location, "region"), dim_devices)
    return (joined.groupBy("region", "device")
            .agg(F.count("review_count").alias("review_count"))
            .orderBy(F.desc("review_count"), "region", "device"))


def q6_top_spenders(fact, k: int = TOP_SPENDERS) -> DataFrame:
    """Top-k customers by spend; ``orderBy().limit()`` plans as a distributed
    TakeOrderedAndProject (each task keeps k rows)."""
    return (fact.groupBy("customer_id")
            .agg(money(F.sum("amount_spent")).alias("total_spent"))
            .orderBy(F.desc("total_spent"), "customer_id")
            .limit(k))


def q7_positive_trend(fact, dim_date) -> DataFrame:
    """Positive reviews by (year, month) of the classification date.

    The fact is reduced to one row per day before it meets the calendar (the
    distinct (date, year, month) rows of ``dim_date``), so the join works on
    at most one row per day on each side.
    """
    per_day = (fact.groupBy(F.to_date("insert_date").alias("log_date"))
               .agg(F.sum("review_score").alias("_pos")))
    calendar = dim_date.select("log_date", "year", "month").distinct()
    return (per_day.join(calendar, "log_date")
            .groupBy("year", "month")
            .agg(F.sum("_pos").cast("bigint").alias("positive_reviews"))
            .orderBy("year", "month"))


def q7_positive_trend_asis(fact, weighted_dim_date) -> DataFrame:
    """The declared Q7: fact ``insert_date`` = ``dim_date.log_date`` against the
    as-written date dim, where each date matches every (log, review) row.

    Result = sum over days of (fact positives of the day) x (dim rows of the
    day), computed from per-day aggregates -- never the many-to-many join.
    """
    per_ts = fact.groupBy("insert_date").agg(F.sum("review_score").alias("_pos"))
    per_date = weighted_dim_date.groupBy("log_date", "year", "month").agg(
        F.sum("_n").alias("_rows"))
    joined = per_ts.join(per_date, per_ts.insert_date == per_date.log_date.cast("timestamp_ntz"))
    return (joined.groupBy("year", "month")
            .agg(F.sum(F.col("_pos") * F.col("_rows")).cast("bigint").alias("positive_reviews"))
            .orderBy("year", "month"))


def q8_avg_spend_by_state(fact, dim_location) -> DataFrame:
    """Average spend per state: exact decimal sum / row count, one double division."""
    return (_with_location(fact, dim_location).groupBy("state")
            .agg((money(F.sum("amount_spent")) / F.count("amount_spent")).alias("avg_spending"))
            .orderBy(F.desc("avg_spending"), "state"))


def m1_reviews_by_location(fact, dim_location) -> DataFrame:
    return (_with_location(fact, dim_location, "location").groupBy("location")
            .agg(F.sum("review_count").cast("bigint").alias("total_reviews"))
            .orderBy(F.desc("total_reviews"), "location"))


def _device_region_totals(fact, dim_location, dim_devices) -> DataFrame:
    joined = _with_device(_with_location(fact, dim_location, "region"), dim_devices)
    return joined.groupBy("region", "device").agg(F.sum("review_count").cast("bigint").alias("total_reviews"))


def m2_reviews_by_device_region(fact, dim_location, dim_devices) -> DataFrame:
    totals = _device_region_totals(fact, dim_location, dim_devices)
    return totals.orderBy("region", F.desc("total_reviews"), "device")


def m3_extreme_states(fact, dim_location) -> DataFrame:
    """The state with the most and the one with the fewest reviews (ties by name).

    Two distributed top-1 selections over the per-state totals.
    """
    totals = m1_reviews_by_location(fact, dim_location).withColumnRenamed("location", "state")
    top = totals.orderBy(F.desc("total_reviews"), "state").limit(1)
    bottom = totals.orderBy(F.asc("total_reviews"), "state").limit(1)
    return (top.select(F.lit("highest").alias("extreme"), "state", "total_reviews")
            .unionByName(bottom.select(F.lit("lowest").alias("extreme"), "state", "total_reviews")))


def m4_device_share(fact, dim_location, dim_devices) -> DataFrame:
    """Share of each device in the reviews of its region."""
    counts = _device_region_totals(fact, dim_location, dim_devices).withColumnRenamed(
        "total_reviews", "reviews")
    region_total = F.sum("reviews").over(Window.partitionBy("region"))
    return counts.select("region", "device", "reviews",
                         (F.col("reviews") / region_total).alias("share"))


def m5_sentiment_trend(reviews) -> DataFrame:
    """Positive and negative review totals per (year, month) of classification."""
    return (reviews.groupBy(F.year("insert_date").cast("bigint").alias("year"),
                            F.month("insert_date").cast("bigint").alias("month"))
            .agg(F.sum("positive_review").cast("bigint").alias("positive_reviews"),
                 F.sum(1 - F.col("positive_review")).cast("bigint").alias("negative_reviews"))
            .orderBy("year", "month"))


def m6_most_positive(fact, dim_location, dim_devices) -> DataFrame:
    """Positive rate per location and per device, in one grouping-sets pass."""
    joined = _with_device(_with_location(fact, dim_location, "location"), dim_devices)
    grouped = joined.groupingSets([["location"], ["device"]], "location", "device").agg(
        F.sum("review_score").cast("bigint").alias("positive_reviews"),
        F.sum("review_count").cast("bigint").alias("total_reviews"),
        F.grouping_id().alias("_g"),
    )
    return grouped.select(
        F.when(F.col("_g") == 1, F.lit("location")).otherwise(F.lit("device")).alias("dimension"),
        F.when(F.col("_g") == 1, F.col("location")).otherwise(F.col("device")).alias("value"),
        "positive_reviews", "total_reviews",
        (F.col("positive_reviews") / F.col("total_reviews")).alias("positive_rate"),
    ).orderBy(F.desc("positive_rate"), "dimension", "value")


def m7_spend_sentiment_corr(fact) -> DataFrame:
    return fact.agg(F.round(F.corr(money("amount_spent"), F.col("review_score").cast("double")), 6)
                    .alias("corr_spend_sentiment"))


def m8_revenue_positive(fact) -> DataFrame:
    pos = fact.where(F.col("review_score") > 0)
    return pos.agg(F.count(F.lit(1)).alias("positive_customers"),
                   money(F.sum("amount_spent")).alias("revenue_positive"))

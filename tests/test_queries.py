"""Q/M queries on a hand-made star schema with values worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from reelstar.plans import queries as A
from reelstar.plans.catalog import QUERIES

D = dt.datetime


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame([
        # fact_key, customer, dev key, loc key, os key, spend, score, count, insert_date
        ("f1", 1, "k1", "k1", "k1", Decimal("10.500"), 2, 2, D(2024, 1, 5)),
        ("f2", 2, "k2", "k2", "k2", Decimal("4.000"), 0, 1, D(2024, 1, 7)),
        ("f3", 3, "k3", "k3", "k3", Decimal("6.000"), 1, 2, D(2024, 2, 1)),
        ("f4", 4, None, None, None, Decimal("1.000"), 1, 1, D(2024, 2, 1)),
    ], "fact_key string, customer_id bigint, id_dim_devices string, id_dim_location string, "
       "id_dim_os string, amount_spent decimal(38,3), review_score bigint, review_count bigint, "
       "insert_date timestamp_ntz")
    loc = spark.createDataFrame([("k1", "NATION_1", 1), ("k2", "NATION_2", 2), ("k3", "NATION_1", 3)],
                                "id_dim_location string, location string, user_id bigint")
    dev = spark.createDataFrame([("k1", "Mobile", 1), ("k2", "Mobile", 2), ("k3", "Tablet", 3)],
                                "id_dim_devices string, device string, user_id bigint")
    dates = spark.createDataFrame([
        ("d1", dt.date(2024, 1, 5), 5, 1, 2024, "Winter", 1),
        ("d2", dt.date(2024, 1, 5), 5, 1, 2024, "Winter", 2),
        ("d3", dt.date(2024, 2, 1), 1, 2, 2024, "Winter", 3),
    ], "id_dim_date string, log_date date, day bigint, month bigint, year bigint, season string, user_id bigint")
    return fact, loc, dev, dates


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_star_queries(star):
    fact, loc, dev, dates = star
    assert rows(A.q1_reviews_by_state_device(fact, loc, dev)) == [("NATION_1", "Mobile", 1),
                                                                  ("NATION_1", "Tablet", 1),
                                                                  ("NATION_2", "Mobile", 1)]
    assert rows(A.q2_positive_by_location(fact, loc)) == [("NATION_1", 3), ("NATION_2", 0)]
    assert rows(A.q6_top_spenders(fact, k=2)) == [(1, 10.5), (3, 6.0)]
    assert rows(A.q8_avg_spend_by_state(fact, loc)) == [("NATION_1", 8.25), ("NATION_2", 4.0)]
    # fact dates 01-05 (score 2), 01-07 (0), 02-01 (1 + 1); the calendar has 01-05 and 02-01
    assert rows(A.q7_positive_trend(fact, dates)) == [(2024, 1, 2), (2024, 2, 2)]


def test_q7_as_written_multiplies_by_dim_rows(spark, star):
    fact, _, _, dates = star
    weighted = dates.selectExpr("*", "1L AS _n")
    # 01-05 matches two dim rows (2 x 2), 02-01 one row (2 x 1)
    assert rows(A.q7_positive_trend_asis(fact, weighted)) == [(2024, 1, 4), (2024, 2, 2)]


def test_metrics(star):
    fact, loc, dev, _ = star
    assert rows(A.m1_reviews_by_location(fact, loc)) == [("NATION_1", 4), ("NATION_2", 1)]
    assert rows(A.m3_extreme_states(fact, loc)) == [("highest", "NATION_1", 4), ("lowest", "NATION_2", 1)]
    assert rows(A.m4_device_share(fact, loc, dev)) == [("NATION_1", "Mobile", 2, 0.5),
                                                       ("NATION_1", "Tablet", 2, 0.5),
                                                       ("NATION_2", "Mobile", 1, 1.0)]
    assert rows(A.m6_most_positive(fact, loc, dev)) == [
        ("device", "Mobile", 2, 3, 2 / 3), ("device", "Tablet", 1, 2, 0.5),
        ("location", "NATION_1", 3, 4, 0.75), ("location", "NATION_2", 0, 1, 0.0)]
    assert rows(A.m8_revenue_positive(fact)) == [(3, 17.5)]
    corr = A.m7_spend_sentiment_corr(fact).first()[0]
    assert -1.0 <= corr <= 1.0


def test_m3_ties_break_by_name(spark):
    fact = spark.createDataFrame([("a", 1, "k1", 3), ("b", 2, "k2", 3)],
                                 "fact_key string, customer_id bigint, id_dim_location string, review_count bigint")
    loc = spark.createDataFrame([("k1", "B", 1), ("k2", "A", 2)],
                                "id_dim_location string, location string, user_id bigint")
    assert rows(A.m3_extreme_states(fact, loc)) == [("highest", "A", 3), ("lowest", "A", 3)]


def test_m5_counts_negatives(spark):
    reviews = spark.createDataFrame([(1, 1, 10, D(2024, 3, 1)), (1, 0, 11, D(2024, 3, 9)), (2, 0, 12, D(2024, 4, 1))],
                                    "user_id bigint, positive_review int, review_id bigint, insert_date timestamp_ntz")
    assert rows(A.m5_sentiment_trend(reviews)) == [(2024, 3, 1, 1), (2024, 4, 0, 1)]


def test_surrogate_keys_are_made_of_distinct_rows(spark):
    plan = QUERIES["surrogate_keys"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    grouped = plan[plan.index("Aggregate ["):]
    keys = grouped[len("Aggregate ["):grouped.index("]")]
    below = grouped[grouped.index("\n"):]
    assert len(keys.split(", ")) == 3 and "md5(" not in below and "md5(" in plan

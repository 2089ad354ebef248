"""Seeded random fixtures: the pre-aggregated as-written fact equals the
literal fan-out join, for both log join keys."""

import datetime as dt
import hashlib
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from reelstar.operators import marts as M

TOKEN = "_dbt_utils_surrogate_key_null_"


def _md5(v):
    return hashlib.md5((TOKEN if v is None else str(v)).encode()).hexdigest()


def _random_frames(spark, seed):
    rng = np.random.default_rng(seed)
    logs, reviews, purchases = [], [], []
    rid = 0
    for u in range(1, 9):
        for _ in range(int(rng.integers(0, 4))):
            rid += 1
            reviews.append((u, int(rng.integers(0, 2)), rid, dt.datetime(2024, 1, int(rng.integers(1, 3)))))
        for j in range(int(rng.integers(0, 5))):
            purchases.append((f"{u}-{j}", "s", "", int(rng.integers(1, 4)), dt.datetime(2024, 1, 1),
                              Decimal(int(rng.integers(1, 999))) / 8, u, "FR"))
    review_ids = [r[2] for r in reviews]
    for u in range(1, 9):
        for _ in range(int(rng.integers(0, 4))):
            lid = u if rng.random() < 0.5 or not review_ids else int(rng.choice(review_ids))
            logs.append((lid, "2024-01-01", "Mobile", "iOS", "L", "ip", "p", ""))
    L = spark.createDataFrame(logs, "log_id bigint, log_date string, device string, os string, "
                                    "location string, ip string, phone_number string, browser string")
    R = spark.createDataFrame(reviews, "user_id bigint, positive_review int, review_id bigint, "
                                       "insert_date timestamp_ntz")
    P = spark.createDataFrame(purchases, "invoice_number string, stock_code string, detail string, "
                                         "quantity bigint, invoice_date timestamp_ntz, "
                                         "unit_price decimal(8,3), customer_id bigint, country string")
    return L, R, P, pd.DataFrame(logs, columns=L.columns), pd.DataFrame(reviews, columns=R.columns), \
        pd.DataFrame(purchases, columns=P.columns)


def _brute(lp, rp, pp, key):
    if lp.empty or rp.empty:
        pairs = pd.DataFrame(columns=["k", "u"])
    else:
        m = lp.merge(rp[["user_id", "review_id"]], left_on="log_id", right_on=key, suffixes=("", "_r"))
        pairs = pd.DataFrame({"k": m["log_id"].map(_md5), "u": m["user_id"]})   # the review's user
    j = pp.merge(rp, left_on="customer_id", right_on="user_id")
    for i in range(3):
        j = j.merge(pairs.rename(columns={"k": f"k{i}", "u": f"u{i}"}), left_on="user_id",
                    right_on=f"u{i}", how="left")
    if j.empty:
        return []
    j["amt"] = [Decimal(int(q)) * p for q, p in zip(j["quantity"], j["unit_price"])]
    g = j.groupby(["customer_id", "k0", "k1", "k2", "insert_date"], dropna=False).agg(
        a=("amt", "sum"), s=("positive_review", "sum"), c=("review_id", "count")).reset_index()
    norm = lambda v: None if (v is None or (isinstance(v, float) and np.isnan(v))) else v
    return sorted((int(r.customer_id), norm(r.k0), norm(r.k1), norm(r.k2), r.insert_date.to_pydatetime(),
                   r.a, int(r.s), int(r.c)) for r in g.itertuples())


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("key", ["user_id", "review_id"])
def test_random_as_written_fact(spark, seed, key):
    L, R, P, lp, rp, pp = _random_frames(spark, seed)
    keys = M.log_keys(L, R, M.AS_WRITTEN, log_join_key=key)
    got = M.fact_as_written(P, R, {n: keys for n in M.FACT_DIMS}).collect()
    got = sorted((r.customer_id, r.id_dim_devices, r.id_dim_location, r.id_dim_os, r.insert_date,
                  r.amount_spent, r.review_score, r.review_count) for r in got)
    assert got == _brute(lp, rp, pp, key)


def test_intent_fact_refuses_several_log_keys_per_user(spark):
    L, R, *_ = _random_frames(spark, 1)
    with pytest.raises(ValueError, match="one log key per customer"):
        M.log_keys(L, R, M.INTENT, log_join_key="review_id")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("key", ["user_id"])
def test_random_intent_fact(spark, seed, key):
    L, R, P, lp, rp, pp = _random_frames(spark, seed)
    keys = M.log_keys(L, R, M.INTENT, log_join_key=key)
    got = sorted((r.customer_id, r.id_dim_devices, r.id_dim_location, r.id_dim_os, r.amount_spent,
                  r.review_score, r.review_count, r.insert_date)
                 for r in M.fact_intent(P, R, {n: keys for n in M.FACT_DIMS}).collect())
    spend = {}
    for q, p, c in zip(pp.quantity, pp.unit_price, pp.customer_id):
        spend[c] = spend.get(c, Decimal(0)) + Decimal(int(q)) * p
    per_user = rp.groupby("user_id").agg(s=("positive_review", "sum"), c=("review_id", "count"),
                                         t=("insert_date", "max"))
    if not lp.empty and not rp.empty:
        m = lp.merge(rp[["user_id", "review_id"]], left_on="log_id", right_on=key, suffixes=("", "_r"))
        lowest = {u: min(_md5(x) for x in grp) for u, grp in m.groupby("user_id")["log_id"]}
    else:
        lowest = {}
    want = sorted((int(u), lowest.get(u), lowest.get(u), lowest.get(u), spend[u], int(r.s), int(r.c),
                   r.t.to_pydatetime()) for u, r in per_user.iterrows() if u in spend)
    assert got == want

"""The pre-aggregated marts against a brute-force fan-out join in pandas,
on a fixture with one hot user holding a third of the rows."""

import datetime as dt
import hashlib
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelstar.operators import marts as M
from reelstar.plans.catalog import QUERIES

TOKEN = "_dbt_utils_surrogate_key_null_"


def _md5(v):
    return hashlib.md5((TOKEN if v is None else str(v)).encode()).hexdigest()


def _fixture(spark):
    logs, reviews, purchases = [], [], []
    for u in range(1, 9):
        n_logs = 3 if u == 1 else (0 if u == 8 else 1)
        for j in range(n_logs):
            logs.append((u, f"2024-0{1 + j % 3}-1{j}", ["Mobile", "Tablet"][j % 2], "iOS",
                         f"L{u % 3}" if u != 5 else "", "10.0.0.1", "000", ""))
        n_rev = 4 if u == 1 else 2
        for j in range(n_rev):
            reviews.append((u, (u + j) % 2, u * 100 + j,
                            dt.datetime(2024, 1 + j % 2, 1 + j % 3)))
        n_p = 9 if u == 1 else 3
        for j in range(n_p):
            purchases.append((str(u * 1000 + j), "s", "", j % 4 + 1, dt.datetime(2024, 1, 1),
                              Decimal(f"{j}.125"), u if u != 7 else 70, "FR"))
    L = spark.createDataFrame(logs, "log_id bigint, log_date string, device string, os string, "
                                    "location string, ip string, phone_number string, browser string")
    R = spark.createDataFrame(reviews, "user_id bigint, positive_review int, review_id bigint, "
                                       "insert_date timestamp_ntz")
    P = spark.createDataFrame(purchases, "invoice_number string, stock_code string, detail string, "
                                         "quantity bigint, invoice_date timestamp_ntz, "
                                         "unit_price decimal(8,3), customer_id bigint, country string")
    return L, R, P


def _brute_asis(L, R, P):
    lp, rp, pp = L.toPandas(), R.toPandas(), P.toPandas()
    pairs = lp.merge(rp[["user_id"]], left_on="log_id", right_on="user_id")
    dims = {}
    for name, (key, _) in [("dim_devices", M.DIMS["dim_devices"]), ("dim_location", M.DIMS["dim_location"]),
                           ("dim_os", M.DIMS["dim_os"])]:
        d = pairs[["log_id", "user_id"]].copy()
        d[key] = d["log_id"].map(_md5)
        dims[name] = d[[key, "user_id"]]
    j = pp.merge(rp, left_on="customer_id", right_on="user_id")
    for name, d in dims.items():
        j = j.merge(d.rename(columns={"user_id": "_u_" + name}), left_on="user_id",
                    right_on="_u_" + name, how="left")
    j["amt"] = j["quantity"].map(Decimal) * j["unit_price"]
    keys = ["customer_id", "id_dim_devices", "id_dim_location", "id_dim_os", "insert_date"]
    g = j.groupby(keys, dropna=False).agg(amount_spent=("amt", "sum"),
                                          review_score=("positive_review", "sum"),
                                          review_count=("review_id", "count")).reset_index()
    return {(r.customer_id, r.insert_date.to_pydatetime()): (r.amount_spent, int(r.review_score), int(r.review_count))
            for r in g.itertuples()}


@pytest.mark.parametrize("shared", [True, False])
def test_fact_as_written_equals_fanout_join(spark, shared):
    L, R, P = _fixture(spark)
    if shared:
        keys = M.log_keys(L, R, M.AS_WRITTEN)
        dims = {n: keys for n in M.FACT_DIMS}
    else:
        dims = {n: M.named_dim(n, L, R, M.AS_WRITTEN, weighted=True) for n in M.FACT_DIMS}
    got = {(r.customer_id, r.insert_date): (r.amount_spent, r.review_score, r.review_count)
           for r in M.fact_as_written(P, R, dims).collect()}
    assert got == _brute_asis(L, R, P)


def test_dim_as_written_rows_equal_pairs(spark):
    L, R, _ = _fixture(spark)
    dim = M.named_dim("dim_devices", L, R, M.AS_WRITTEN)
    lp, rp = L.toPandas(), R.toPandas()
    pairs = lp.merge(rp[["user_id"]], left_on="log_id", right_on="user_id")
    want = sorted((_md5(a), b, c) for a, b, c in zip(pairs.log_id, pairs.device, pairs.user_id))
    assert sorted(tuple(r) for r in dim.collect()) == want
    small_chunks = M.replicate(M.named_dim("dim_devices", L, R, M.AS_WRITTEN, weighted=True), chunk=5)
    assert sorted(tuple(r) for r in small_chunks.collect()) == want


def test_fact_intent_one_row_per_customer_and_spend_invariant(spark):
    L, R, P = _fixture(spark)
    keys = M.log_keys(L, R, M.INTENT)
    fact = M.fact_intent(P, R, {n: keys for n in M.FACT_DIMS})
    rows = fact.collect()
    assert len(rows) == len({r.customer_id for r in rows})
    pp, rp = P.toPandas(), R.toPandas()
    reviewed = pp[pp.customer_id.isin(set(rp.user_id))]
    assert sum(r.amount_spent for r in rows) == sum(q * p for q, p in zip(reviewed.quantity, reviewed.unit_price))
    no_log = {r.customer_id for r in rows if r.id_dim_devices is None}
    assert no_log == {8}
    per_dim = M.fact_intent(P, R, {n: M.named_dim(n, L, R) for n in M.FACT_DIMS})
    assert sorted(map(tuple, per_dim.collect())) == sorted(map(tuple, rows))


def test_star_dims_equal_the_single_dims(spark):
    L, R, _ = _fixture(spark)
    L = L.union(L.limit(2)).union(L.limit(1).select(*(F.lit(None).cast(t).alias(c) if c == "device" else c for c, t in L.dtypes)))
    names = ("dim_location", "dim_devices")
    dims = M.star_dims(M.star_rows(L, R, names), names)

    def rows(df, *cols):
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

    for n in names:
        cols = (M.DIMS[n][0], *M.DIMS[n][1], "user_id")
        assert rows(dims[n], *cols) == rows(M.named_dim(n, L, R), *cols)
    assert rows(dims[M.LOG_KEY], "user_id", M.LOG_KEY) == rows(M.log_keys(L, R), "user_id", M.LOG_KEY)


@pytest.mark.parametrize("key", ["q1_reviews_by_state_device", "q2_positive_by_location", "q5_device_by_region", "m4_device_share", "m6_most_positive"])
def test_star_queries_scan_the_logs_once(spark, key):
    df = QUERIES[key](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert sum("FileScan" in line and "events" in line for line in plan.split("\n")) == 1
    assert "SortAggregate" not in plan


def test_mode_is_checked(spark):
    L, R, _ = _fixture(spark)
    with pytest.raises(ValueError):
        M.named_dim("dim_os", L, R, "sideways")


def test_as_written_fact_hot_customer_without_fanout(spark):
    """One customer with 3,000 purchases, 200 reviews and 40 logs: the declared
    join would hold 3,000 x 200 x (40 x 200)^3 ~ 3e17 rows; the plan computes
    the groups from aggregates in seconds, and the values follow in closed form."""
    from pyspark.sql import functions as F
    P_, R_, L_ = 3000, 200, 40
    purchases = spark.range(P_).select(
        F.col("id").cast("string").alias("invoice_number"), F.lit("s").alias("stock_code"),
        F.lit("").alias("detail"), F.lit(2).cast("bigint").alias("quantity"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("invoice_date"),
        F.lit("1.250").cast("decimal(8,3)").alias("unit_price"),
        F.lit(1).cast("bigint").alias("customer_id"), F.lit("FR").alias("country"))
    reviews = spark.range(R_).select(
        F.lit(1).cast("bigint").alias("user_id"), (F.col("id") % 2).cast("int").alias("positive_review"),
        F.col("id").alias("review_id"), F.lit("2024-02-01").cast("timestamp_ntz").alias("insert_date"))
    logs = spark.range(L_).select(
        F.lit(1).cast("bigint").alias("log_id"), F.lit("2024-01-01").alias("log_date"),
        F.lit("Mobile").alias("device"), F.lit("iOS").alias("os"), F.lit("L").alias("location"),
        F.lit("ip").alias("ip"), F.lit("p").alias("phone_number"), F.lit("").alias("browser"))
    keys = M.log_keys(logs, reviews, M.AS_WRITTEN)
    rows = M.fact_as_written(purchases, reviews, {n: keys for n in M.FACT_DIMS}).collect()
    assert len(rows) == 1
    w = (L_ * R_) ** 3                                   # rows per customer in each as-written dim, cubed
    r = rows[0]
    assert r.amount_spent == Decimal("2.500") * P_ * R_ * w
    assert r.review_score == (R_ // 2) * P_ * w
    assert r.review_count == R_ * P_ * w


def _review_keyed_logs(spark):
    rows = []
    for u in range(1, 8):
        for j in range(3 if u == 1 else 1):
            rows.append((u * 100 + j, f"2024-0{1 + j}-01", ["Mobile", "Tablet"][j % 2], "iOS", f"L{u % 3}",
                         "ip", "p", ""))
    rows.append((999, "2024-01-01", "Mobile", "iOS", "L0", "ip", "p", ""))     # matches no review
    return spark.createDataFrame(rows, "log_id bigint, log_date string, device string, os string, "
                                       "location string, ip string, phone_number string, browser string")


def test_review_id_join_key_dims_and_fact_match_brute_force(spark):
    _, R, P = _fixture(spark)
    L = _review_keyed_logs(spark)
    lp, rp, pp = L.toPandas(), R.toPandas(), P.toPandas()
    pairs = lp.merge(rp[["review_id", "user_id"]], left_on="log_id", right_on="review_id")
    want = sorted((_md5(a), b, int(c)) for a, b, c in zip(pairs.log_id, pairs.device, pairs.user_id))
    got = M.named_dim("dim_devices", L, R, M.AS_WRITTEN, log_join_key="review_id")
    assert sorted(tuple(r) for r in got.collect()) == want
    intent = M.named_dim("dim_devices", L, R, log_join_key="review_id")
    assert sorted(tuple(r) for r in intent.collect()) == sorted(set(want))

    # as-written fact with these dims against the literal fan-out join
    dims = {n: M.named_dim(n, L, R, M.AS_WRITTEN, weighted=True, log_join_key="review_id") for n in M.FACT_DIMS}
    keys = M.log_keys(L, R, M.AS_WRITTEN, log_join_key="review_id")
    shared = {n: keys for n in M.FACT_DIMS}
    d = pairs[["log_id", "user_id"]].copy()
    d["k"] = d["log_id"].map(_md5)
    j = pp.merge(rp, left_on="customer_id", right_on="user_id")
    for i in range(3):
        j = j.merge(d[["k", "user_id"]].rename(columns={"k": f"k{i}", "user_id": f"u{i}"}),
                    left_on="user_id", right_on=f"u{i}", how="left")
    j["amt"] = j["quantity"].map(Decimal) * j["unit_price"]
    g = j.groupby(["customer_id", "k0", "k1", "k2", "insert_date"], dropna=False).agg(
        a=("amt", "sum"), s=("positive_review", "sum"), c=("review_id", "count")).reset_index()
    brute = sorted((r.customer_id, None if pd.isna(r.k0) else r.k0, r.insert_date.to_pydatetime(),
                    r.a, int(r.s), int(r.c)) for r in g.itertuples())
    for variant in (dims, shared):
        rows = M.fact_as_written(P, R, variant).collect()
        assert sorted((r.customer_id, r.id_dim_devices, r.insert_date, r.amount_spent, r.review_score,
                       r.review_count) for r in rows) == brute

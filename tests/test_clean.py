import datetime as dt
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from reelstar.operators import clean as C
from reelstar.operators import staging as S
from reelstar.schemas import RAW_PURCHASE
from reelstar.sources.files import read_csv

CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
536365,85123A,WHITE HANGING HEART,6,12/1/2010 8:26,2.5555,17850.0,United Kingdom
536366,71053,,8,12/1/2010 8:28,3.39,17851.0,France
536367,84406B,CREAM CUPID,2,bad,2.75,,United Kingdom
536368,84029G,UNION FLAG,6,,3.39,13047,Spain
"""


def _raw(spark, tmp_path):
    p = tmp_path / "purchases.csv"
    p.write_text(CSV)
    return read_csv(spark, str(p), RAW_PURCHASE)


def test_clean_edge_rows(spark, tmp_path):
    clean = C.clean_user_purchase(_raw(spark, tmp_path))
    rows = {r["invoice_number"]: r for r in clean.collect()}
    assert set(rows) == {"536365", "536366", "536368"}          # missing customer dropped
    first = rows["536365"]
    assert first["customer_id"] == 17850                        # '17850.0' -> 17850
    assert first["invoice_date"] == dt.datetime(2010, 12, 1, 8, 26)
    assert first["unit_price"] == Decimal("2.556")              # rounds half up
    assert rows["536366"]["detail"] == ""                       # missing text -> ''
    assert rows["536368"]["invoice_date"] is None               # missing date -> null
    staged = S.stg_user_purchase(clean)
    assert sorted(r[0] for r in staged.select("invoice_number").collect()) == ["536365", "536366"]
    assert dict(staged.dtypes)["invoice_date"] == "timestamp_ntz"
    assert dict(staged.dtypes)["unit_price"] == "decimal(8,3)"


def test_cleaning_metrics_one_pass(spark, tmp_path):
    m = C.cleaning_metrics(_raw(spark, tmp_path)).first().asDict()
    # text columns of kept rows that were missing: one Description, one InvoiceDate
    assert m == {"rows_in": 4, "dropped_missing_customer": 1, "filled_values": 2, "rows_out": 3}


def _purchases(spark):
    rows = [("1", "a", "x", 5, dt.datetime(2024, 1, 2), Decimal("1.000"), 7, "FR"),
            ("1", "a", "x", 3, dt.datetime(2024, 1, 1), Decimal("2.000"), 7, "FR"),
            ("1", "a", "y", 3, dt.datetime(2024, 1, 1), Decimal("2.000"), 7, "FR"),
            ("2", "b", "z", 1, dt.datetime(2024, 1, 1), Decimal("1.500"), 8, "DE"),
            ("3", "c", "w", 1, dt.datetime(2024, 1, 3), Decimal("9.000"), 9, "ES")]
    schema = ("invoice_number string, stock_code string, detail string, quantity bigint, "
              "invoice_date timestamp_ntz, unit_price decimal(8,3), customer_id bigint, country string")
    return spark.createDataFrame(rows, schema)


def test_insert_new_first_row_per_key_and_ignores_existing(spark):
    incoming = _purchases(spark)
    target = spark.createDataFrame([("2", "b")], "invoice_number string, stock_code string")
    got = sorted(tuple(r) for r in C.insert_new(incoming, target).collect())
    assert [g[:4] for g in got] == [("1", "a", "x", 3), ("3", "c", "w", 1)]


def test_first_per_key_hot_key_matches_brute_force(spark):
    pdf = pd.DataFrame({"k": [i % 3 if i % 10 else 0 for i in range(3000)],
                        "o": [(i * 7919) % 1000 for i in range(3000)],
                        "v": [str(i) for i in range(3000)]})
    df = spark.createDataFrame(pdf).repartition(6)
    got = {r["k"]: (r["o"], r["v"]) for r in C.first_per_key(df, ["k"], ["o"]).collect()}
    want = {k: tuple(g.sort_values(["o", "v"]).iloc[0][["o", "v"]]) for k, g in pdf.groupby("k")}
    assert got == {k: (int(o), v) for k, (o, v) in want.items()}


def test_dense_serial_id_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k")).repartition(7)
    got = C.dense_serial_id(df, ["k"]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 5001))
    assert [r["k"] for r in got] == list(range(5000))


def test_dense_serial_id_hot_identical_rows_split_in_chunks(spark):
    hot = spark.range(0, 3000).select(F.lit(5).cast("bigint").alias("k"), F.lit("same").alias("v"))
    rest = spark.range(0, 2000).select((F.col("id") % 10).alias("k"), F.col("id").cast("string").alias("v"))
    df = hot.unionByName(rest).repartition(5)
    got = C.dense_serial_id(df, ["k"], chunk=64).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 5001))
    want = sorted((r["k"], r["v"]) for r in df.collect())
    assert [(r["k"], r["v"]) for r in got] == want


def test_observed_metrics_equal_separate_pass(spark, tmp_path):
    raw = _raw(spark, tmp_path)
    clean, obs = C.clean_observed(raw)
    clean.write.format("noop").mode("overwrite").save()
    assert obs.get == C.cleaning_metrics(raw).first().asDict()


def test_cluster_conf_scales_with_input():
    from reelstar.session import cluster_conf
    conf = cluster_conf(100 << 40, 1000, 8)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


def test_inferred_schema_path_gives_same_clean_rows(spark, tmp_path):
    from reelstar.sources.files import read_csv_inferred
    p = tmp_path / "purchases.csv"
    p.write_text(CSV)
    inferred = read_csv_inferred(spark, str(p))
    assert dict(inferred.dtypes)["CustomerID"] == "double"       # '17850.0' infers as double
    typed = inferred.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_PURCHASE.fields])
    a = sorted(map(tuple, C.clean_user_purchase(typed).collect()))
    b = sorted(map(tuple, C.clean_user_purchase(_raw(spark, tmp_path)).collect()))
    assert a == b


def test_dense_serial_id_shuffles_offsets_alone_after_the_sort(spark):
    df = spark.range(0, 400).select((F.col("id") % 7).alias("k"), F.lit(None).cast("string").alias("v")).repartition(5)
    out = C.dense_serial_id(df, ["k"])
    assert "strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["id"] for r in out.collect()) == list(range(1, 401))
    assert C.dense_serial_id(df.limit(0), ["k"]).count() == 0

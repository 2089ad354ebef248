import datetime as dt
from decimal import Decimal

from reelstar.schemas import STG_USER_PURCHASE
from reelstar.sources import jdbc, sinks
from reelstar.sources.files import read_csv

ROWS = [("1", "a", "d", 2, dt.datetime(2024, 1, 1, 8, 26), Decimal("1.500"), 7, "FR"),
        ("2", "b", "", 1, dt.datetime(2024, 1, 2), Decimal("2.000"), 8, "DE"),
        ("3", "c", "x", 4, dt.datetime(2024, 1, 3), Decimal("0.125"), 9, "ES")]


def test_jdbc_round_trip_in_memory_derby(spark):
    df = spark.createDataFrame(ROWS, STG_USER_PURCHASE)
    url = "jdbc:derby:memory:reelstar_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    jdbc.write_jdbc(df.drop("invoice_date"), url, "USER_PURCHASE", mode="overwrite",
                    batch_size=2, properties=props)
    back = jdbc.read_jdbc(spark, url, "USER_PURCHASE", column="customer_id", partitions=2, properties=props)
    assert back.rdd.getNumPartitions() == 2
    assert sorted(r.customer_id for r in back.collect()) == [7, 8, 9]


def test_csv_export_and_reload_as_table(spark, tmp_path):
    df = spark.createDataFrame(ROWS, STG_USER_PURCHASE)
    sinks.export_csv(df, str(tmp_path / "csv"))
    t = sinks.csv_to_table(spark, str(tmp_path / "csv"), STG_USER_PURCHASE, "reelstar_csv_t")
    assert sorted(r.unit_price for r in t.collect()) == [Decimal("0.125"), Decimal("1.500"), Decimal("2.000")]


def test_create_table_if_absent_and_partitioned_parquet(spark, tmp_path):
    sinks.create_table_if_absent(spark, "user_purchase_t", STG_USER_PURCHASE, database="reelstar_db")
    sinks.create_table_if_absent(spark, "user_purchase_t", STG_USER_PURCHASE, database="reelstar_db")
    assert spark.table("reelstar_db.user_purchase_t").schema["unit_price"].dataType.simpleString() == "decimal(8,3)"
    df = spark.createDataFrame(ROWS, STG_USER_PURCHASE)
    sinks.write_parquet(df, str(tmp_path / "p"), partition_by=["country"])
    back = spark.read.parquet(str(tmp_path / "p")).where("country = 'FR'")
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(country" in back._jdf.queryExecution().executedPlan().toString()


def test_materialize_bucketed(spark):
    df = spark.createDataFrame(ROWS, STG_USER_PURCHASE)
    t = sinks.materialize(df, "reelstar_mat_t", sort_within=["customer_id"], bucket_by=(4, ["customer_id"]))
    assert t.count() == 3


def test_append_table_accumulates(spark):
    df = spark.createDataFrame(ROWS, STG_USER_PURCHASE)
    sinks.append_table(df, "reelstar_append_t", partition_by=["country"])
    sinks.append_table(df, "reelstar_append_t", partition_by=["country"])
    assert spark.table("reelstar_append_t").count() == 6


def test_csv_export_reload_keeps_texts(spark, tmp_path):
    texts = ['say "hi", ok', "two\nlines", "a\r\nb", "", None, "  blank  ", "back\\slash", '"', "ü,東", '\\"']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    sinks.export_csv(df, str(tmp_path / "csv"))
    back = sinks.csv_to_table(spark, str(tmp_path / "csv"), df.schema, "reelstar_csv_texts")
    assert sorted(map(tuple, back.collect())) == list(enumerate(texts))

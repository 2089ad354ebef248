"""The daily jobs from CSV exports of the sf0.001 feeds give the same fact
as the direct plan over the Parquet tables."""

from pyspark.sql import functions as F

from reelstar.operators import clean as C
from reelstar.operators import marts as M
from reelstar.plans import feeds, jobs
from reelstar.plans.warehouse import Warehouse
from reelstar.sources.sinks import export_csv

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_path):
    raw_p = feeds.raw_purchases(spark, SF)
    export_csv(raw_p, str(tmp_path / "purchases"))
    logs = feeds.raw_logs(spark, SF)
    export_csv(logs.repartition(3), str(tmp_path / "logs"))
    texts = feeds.review_texts(spark, SF)
    export_csv(texts.select("cid", "review_str", "id_review").repartition(2), str(tmp_path / "reviews"))

    metrics = {}
    n1 = jobs.load_purchases(spark, str(tmp_path / "purchases"), table="job_user_purchase", metrics=metrics)
    assert metrics["rows_in"] == raw_p.count()
    assert metrics["rows_out"] == raw_p.where("CustomerID is not null").count()
    n2 = jobs.load_purchases(spark, str(tmp_path / "purchases"), table="job_user_purchase")
    assert n1 > 0 and n2 == 0                     # re-running inserts nothing
    purchases = spark.table("job_user_purchase")
    assert purchases.count() == n1

    assert jobs.load_logs(spark, str(tmp_path / "logs"), str(tmp_path / "ledger_l"), str(tmp_path / "t_logs")) == 3
    assert jobs.load_logs(spark, str(tmp_path / "logs"), str(tmp_path / "ledger_l"), str(tmp_path / "t_logs")) == 0
    parsed = spark.read.parquet(str(tmp_path / "t_logs"))

    n = jobs.load_reviews(spark, str(tmp_path / "reviews"), str(tmp_path / "ledger_r"),
                          str(tmp_path / "t_reviews"), model_dir=str(tmp_path / "model"), training=texts,
                          batch_ts=F.lit("2024-01-01").cast("timestamp"))
    assert n == 2
    classified = spark.read.parquet(str(tmp_path / "t_reviews"))
    assert classified.count() == texts.count()

    # with the label-as-classifier reviews, the marts equal the direct plan
    w = Warehouse(spark, SF)
    marts = jobs.build_marts(purchases, w.classified_movie_review, parsed, prefix="job_")
    # the purchase table holds the first row per (invoice, stock code)
    once = C.first_per_key(w.user_purchase, C.PURCHASE_KEY, ("invoice_date", "quantity", "unit_price"))
    want = jobs.build_marts(once, w.classified_movie_review, w.review_logs, store=False)["fact_movie_analytics"]
    got = marts["fact_movie_analytics"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert set(marts) == {"dim_date", "dim_devices", "dim_location", "dim_os", "dim_ip",
                          "dim_phone_number", "fact_movie_analytics"}


def test_log_stream_job(spark, tmp_path):
    logs = feeds.raw_logs(spark, SF)
    export_csv(logs.repartition(2), str(tmp_path / "logs"))
    assert jobs.load_logs(spark, str(tmp_path / "logs"), str(tmp_path / "ckpt"), str(tmp_path / "out"), stream=True) == 1
    assert jobs.load_logs(spark, str(tmp_path / "logs"), str(tmp_path / "ckpt"), str(tmp_path / "out"), stream=True) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == logs.count()


def test_review_stream_job(spark, tmp_path):
    texts = feeds.review_texts(spark, SF)
    export_csv(texts.select("cid", "review_str", "id_review").repartition(2), str(tmp_path / "reviews"))
    args = (spark, str(tmp_path / "reviews"), str(tmp_path / "ckpt"), str(tmp_path / "out"))
    kw = dict(model_dir=str(tmp_path / "model"), training=texts, stream=True)
    assert jobs.load_reviews(*args, **kw) == 1
    assert jobs.load_reviews(*args, **kw) == 0
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == texts.count()
    assert {r[0] for r in out.select("positive_review").distinct().collect()} <= {0, 1}


def test_reviews_scored_by_a_model_fitted_for_the_run(spark, tmp_path):
    src = tmp_path / "reviews"
    src.mkdir()
    (src / "a.csv").write_text("cid,review_str,id_review\n1,good film,10\n2,,11\n3,bad plot,12\n")
    rows = [(i, "good film" if i % 2 else "bad plot", i, "positive" if i % 2 else "negative") for i in range(20)]
    training = spark.createDataFrame(rows, "cid long, review_str string, id_review long, label string")
    out = str(tmp_path / "out")
    assert jobs.load_reviews(spark, str(src), str(tmp_path / "ledger"), out, training=training) == 1
    got = {r.review_id: r.positive_review for r in spark.read.parquet(out).collect()}
    assert got[10] == 1 and got[12] == 0 and set(got) == {10, 11, 12}


def test_query_sees_files_added_since_the_last_one(spark, tmp_path):
    from reelstar.plans.catalog import QUERIES
    folder = tmp_path / "sf"
    for name in ("events", "documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(folder / f"{name}.parquet"))
    first = QUERIES["review_logs_parsed"](spark, str(folder)).count()
    spark.read.parquet(f"{SF}/events.parquet").write.mode("append").parquet(str(folder / "events.parquet"))
    assert QUERIES["review_logs_parsed"](spark, str(folder)).count() == 2 * first

"""Named queries: one callable ``(spark, data_dir) -> DataFrame`` per operator
of the inventory.  Each reads the data folder's tables and derives everything
else on Spark, so its work grows with the data."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.functions import money, parse_date, parse_invoice_ts, season, surrogate_key, xml_tag
from reelstar.operators import bayes
from reelstar.operators import clean as C
from reelstar.operators import incremental as inc
from reelstar.operators import marts as M
from reelstar.operators import quality as Q
from reelstar.operators import serial as N
from reelstar.operators import staging as S
from reelstar.plans import feeds
from reelstar.plans import queries as A
from reelstar.plans.warehouse import Warehouse
from reelstar.schemas import RAW_PURCHASE
from reelstar.session import cut_lineage, scratch_folder, store
from reelstar.sources import bucketed as B
from reelstar.sources import infer
from reelstar.sources import ledger as L
from reelstar.sources import metrics as K
from reelstar.sources import quarantine as R
from reelstar.sources.clustered import write_clustered
from reelstar.sources.files import list_files, table
from reelstar.sources.sinks import csv_to_table, export_csv
from reelstar.streaming import ingest as I

REVIEW_IDS = T.StructType([T.StructField("cid", T.LongType()), T.StructField("id_review", T.LongType())])
LOG_FILE = T.StructType([T.StructField("id_review", T.LongType()), T.StructField("logs", T.StringType())])

REVIEW_TEXT = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("text", "lang", "source"))])

Query = Callable[[SparkSession, str], DataFrame]


def _w(spark: SparkSession, data_dir: str) -> Warehouse:
    return Warehouse(spark, data_dir)


# -- cleaning and staging -------------------------------------------------------

def clean_user_purchase(spark, d):
    return _w(spark, d).user_purchase


def drop_missing_customer(spark, d):
    return C.drop_missing_customer(_w(spark, d).raw_purchases)


def fill_missing_text(spark, d):
    return C.fill_missing_text(C.drop_missing_customer(_w(spark, d).raw_purchases))


def parse_invoice_date(spark, d):
    raw = _w(spark, d).raw_purchases
    return raw.select(F.col("InvoiceNo").alias("invoice_number"),
                      F.col("StockCode").alias("stock_code"),
                      F.col("InvoiceDate").alias("invoice_date_text"),
                      parse_invoice_ts("InvoiceDate").alias("invoice_date"))


def cleaning_metrics(spark, d):
    return C.cleaning_metrics(_w(spark, d).raw_purchases)


def stg_user_purchase(spark, d):
    return _w(spark, d).stg_user_purchase


def review_logs_parsed(spark, d):
    return S.parse_review_logs(_w(spark, d).raw_logs)


def stg_review_logs(spark, d):
    return S.stg_review_logs(S.parse_review_logs(_w(spark, d).raw_logs))


def positive_review_flag(spark, d):
    raw = _w(spark, d).raw_reviews
    return S.classify_output_to_flag(raw).select(
        F.col("id_review").alias("review_id"), "sentiment", "positive_review")


def classified_movie_review(spark, d):
    return _w(spark, d).classified_movie_review


def stg_classified_movie_review(spark, d):
    return S.stg_classified_movie_review(_w(spark, d).classified_movie_review)


def season_of_date(spark, d):
    logs = _w(spark, d).stg_review_logs
    day = parse_date("log_date")
    return logs.select("log_id", day.alias("log_date"), season(day).alias("season"))


def surrogate_keys(spark, d):
    # distinct before the keys: they follow from these columns, and a task holds and sends the short rows
    p = _w(spark, d).stg_user_purchase.select("invoice_number", "stock_code", "customer_id").distinct()
    return p.select(
        "invoice_number", "stock_code", "customer_id",
        surrogate_key("invoice_number", "stock_code").alias("purchase_key"),
        surrogate_key("customer_id").alias("customer_key"),
    )


def page_titles(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", xml_tag("html", "title").alias("title"))


# -- marts -----------------------------------------------------------------------

def _dim_query(name: str, mode: str) -> Query:
    def run(spark, d):
        return _w(spark, d).dim(name, mode)
    run.__name__ = name if mode == M.INTENT else f"{name}_asis"
    return run


def customer_spend(spark, d):
    p = _w(spark, d).stg_user_purchase
    return p.groupBy("customer_id").agg(
        money(F.sum(F.col("quantity") * F.col("unit_price"))).alias("amount_spent"))


def review_scores(spark, d):
    r = _w(spark, d).stg_classified_movie_review
    return r.groupBy("user_id").agg(
        F.sum("positive_review").cast("bigint").alias("review_score"),
        F.count("review_id").alias("review_count"))


def purchases_with_reviews(spark, d):
    """Inner equi-join of purchases with their customer's review summary.

    The review side is aggregated to one row per user first, so each purchase
    row meets exactly one partner (no purchase x review pairs).
    """
    w = _w(spark, d)
    per_user = w.stg_classified_movie_review.groupBy("user_id").agg(
        F.count("review_id").alias("review_count"),
        F.sum("positive_review").cast("bigint").alias("positive_reviews"))
    p = w.stg_user_purchase
    return p.join(per_user, p.customer_id == per_user.user_id).select(
        "invoice_number", "stock_code", "customer_id", "quantity", "unit_price",
        "review_count", "positive_reviews")


def _fact_out(fact: DataFrame) -> DataFrame:
    return fact.withColumn("amount_spent", money("amount_spent"))


def fact_movie_analytics(spark, d):
    return _fact_out(_w(spark, d).fact(M.INTENT))


def fact_movie_analytics_asis(spark, d):
    return _fact_out(_w(spark, d).fact(M.AS_WRITTEN))


def fact_clustered_readback(spark, d):
    """The fact from a store in Z-order of customer and amount, a folder a year; the
    latest year is stored with wrong scores at first and then replaced alone."""
    path = scratch_folder(spark, "clustered")
    fact = cut_lineage(_w(spark, d).fact(M.INTENT).withColumn("year", F.coalesce(F.year("insert_date"), F.lit(0))))
    last = fact.agg(F.max("year")).first()[0] or 0
    score = F.when(F.col("year") == last, F.lit(-1)).otherwise(F.col("review_score")).cast("bigint")
    by = ["customer_id", "amount_spent"]
    write_clustered(fact.withColumn("review_score", score), path, by, partition_by=["year"])
    write_clustered(fact.where(F.col("year") == last), path, by, partition_by=["year"])
    return _fact_out(spark.read.schema(fact.schema).parquet(path).drop("year"))


# -- analytic queries ------------------------------------------------------------

def _star(spark, d):
    return _w(spark, d).star("dim_location", "dim_devices")


def q1(spark, d):
    f, loc, dev = _star(spark, d)
    return A.q1_reviews_by_state_device(f, loc, dev)


def q2(spark, d):
    f, loc = _w(spark, d).star("dim_location")
    return A.q2_positive_by_location(f, loc)


def q3(spark, d):
    return A.q3_revenue_sentiment(_w(spark, d).fact(M.INTENT))


def q5(spark, d):
    f, loc, dev = _star(spark, d)
    return A.q5_device_by_region(f, loc, dev)


def q6(spark, d):
    return A.q6_top_spenders(_w(spark, d).fact(M.INTENT))


def q7(spark, d):
    w = _w(spark, d)
    return A.q7_positive_trend(w.fact(M.INTENT), w.dim("dim_date"))


def q7_asis(spark, d):
    w = _w(spark, d)
    return A.q7_positive_trend_asis(w.fact(M.AS_WRITTEN), w.dim("dim_date", M.AS_WRITTEN, weighted=True))


def q8(spark, d):
    f, loc = _w(spark, d).star("dim_location")
    return A.q8_avg_spend_by_state(f, loc)


def m1(spark, d):
    f, loc = _w(spark, d).star("dim_location")
    return A.m1_reviews_by_location(f, loc)


def m2(spark, d):
    f, loc, dev = _star(spark, d)
    return A.m2_reviews_by_device_region(f, loc, dev)


def m3(spark, d):
    f, loc = _w(spark, d).star("dim_location")
    return A.m3_extreme_states(f, loc)


def m4(spark, d):
    f, loc, dev = _star(spark, d)
    return A.m4_device_share(f, loc, dev)


def m5(spark, d):
    return A.m5_sentiment_trend(_w(spark, d).stg_classified_movie_review)


def m6(spark, d):
    f, loc, dev = _star(spark, d)
    return A.m6_most_positive(f, loc, dev)


def m7(spark, d):
    return A.m7_spend_sentiment_corr(_w(spark, d).fact(M.INTENT))


def m8(spark, d):
    return A.m8_revenue_positive(_w(spark, d).fact(M.INTENT))


# -- data quality ----------------------------------------------------------------

# The sources that a checked model is built from.
DQ_SOURCES = {"user_purchase": ("user_purchase",), "stg_user_purchase": ("user_purchase",),
              "classified_movie_review": ("classified_movie_review",), "stg_classified_movie_review": ("classified_movie_review",),
              "review_logs": ("review_logs",), "stg_review_logs": ("review_logs",),
              "fact_movie_analytics": ("user_purchase", "classified_movie_review", "review_logs")}
DQ_DIM = ("classified_movie_review", "review_logs")


def dq_tables(w: Warehouse, mode: str = M.INTENT, models: set[str] | None = None) -> dict[str, DataFrame]:
    """The models the declared suite checks.

    Of the sources, those from which two or more of ``models`` (default: all)
    are built are written once to the shared checkpoint folder, so that check
    branches do not each rebuild the feeds; the others are read in place, with
    the columns that the checks need.
    """
    from reelstar.plans.jobs import build_marts
    from reelstar.session import cut_lineage_all
    names = models or {x for c in Q.DECLARED_SUITE for x in (c.model, c.to) if x}
    used = [s for m in names for s in DQ_SOURCES.get(m, DQ_DIM)]
    sources = {"user_purchase": w.user_purchase, "classified_movie_review": w.classified_movie_review, "review_logs": w.review_logs}
    shared = [s for s in sources if used.count(s) > 1]
    sources.update(zip(shared, cut_lineage_all([sources[s] for s in shared])))
    up, cr, rl = sources.values()
    tables = {**sources, "stg_review_logs": S.stg_review_logs(rl), "stg_classified_movie_review": cr,
              "stg_user_purchase": S.stg_user_purchase(up)}
    tables.update(build_marts(up, cr, rl, mode, store=False))
    return tables


def _dq(kind: str | None, mode: str = M.INTENT) -> Query:
    def run(spark, d):
        suite = Q.DECLARED_SUITE if kind is None else Q.checks_of_kind(kind)
        models = {x for c in suite for x in (c.model, c.to) if x}
        return Q.run_checks(dq_tables(_w(spark, d), mode, models), suite)
    run.__name__ = f"dq_{kind or 'report'}" + ("_asis" if mode == M.AS_WRITTEN else "")
    return run


# -- incremental loading ---------------------------------------------------------

LATE_EVERY = 5            # files with a fifth of the rows arrive late
FILES_PER_TRIGGER = 8
ROWS_PER_FILE = 100_000


def _file_feed(spark, d):
    """Review rows as CSV files, one folder per source; files of the sources with an
    even number are ingested (and so in the ledger), the others arrived since."""
    folder = scratch_folder(spark, "feed")
    rows = feeds.review_sources(spark, d)
    even = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("bigint") % 2 == 0, F.lit(False))
    export_csv(rows.where(even), f"{folder}/in", "append", ["source"], ROWS_PER_FILE)
    ledger = f"{folder}/ledger"
    I.ingest_with_ledger(spark, f"{folder}/in", ledger, REVIEW_IDS, lambda df: df, f"{folder}/out")
    export_csv(rows.where(~even), f"{folder}/in", "append", ["source"], ROWS_PER_FILE)
    return list_files(spark, f"{folder}/in", "*.csv"), L.read_ledger(spark, ledger)


def _folders(files: DataFrame) -> DataFrame:
    return files.select(F.url_decode(F.regexp_extract("path", "/(source=[^/]*)/[^/]*$", 1)).alias("path")).distinct()


def ingest_new_files(spark, d):
    """Folders of the listed files that the ledger does not hold."""
    listing, ledger = _file_feed(spark, d)
    return _folders(L.new_files(listing, ledger))


def ledger_merge(spark, d):
    """Folders of the ledger's files once the new ones are added."""
    listing, ledger = _file_feed(spark, d)
    return _folders(L.merge(ledger, L.new_files(listing, ledger)))


def ingest_files_roundtrip(spark, d):
    """Logs written as CSV files and ingested by the file stream, a bounded number of
    files at a time: the first run dies after a batch's data write, the next
    replays it, a late set of files is picked up alone, a last run finds nothing."""
    folder = scratch_folder(spark, "stream")
    logs = feeds.raw_logs(spark, d)
    late = F.crc32(F.col("logs").cast("binary")) % LATE_EVERY == 0

    def run(**kw):
        return I.ingest_stream(spark, f"{folder}/in", LOG_FILE, S.parse_review_logs, f"{folder}/out",
                               max_files_per_trigger=FILES_PER_TRIGGER, **kw)

    export_csv(logs.where(~late), f"{folder}/in", "append", rows_per_file=ROWS_PER_FILE)
    try:
        run(fail_before_commit=True)
    except StreamingQueryException as e:
        if "InjectedFailure" not in str(e):
            raise
    run()
    export_csv(logs.where(late), f"{folder}/in", "append", rows_per_file=ROWS_PER_FILE)
    run()
    if run():
        raise RuntimeError("a file was ingested twice")
    return spark.read.parquet(f"{folder}/out").drop("batch")


def load_rejects(spark, d):
    """Outcomes of a purchase load whose files hold prices and dates that do not parse."""
    folder = scratch_folder(spark, "rejects")
    export_csv(feeds.faulty_purchases(spark, d), f"{folder}/in", rows_per_file=ROWS_PER_FILE)
    R.load(spark, f"{folder}/in", RAW_PURCHASE, f"{folder}/out", *R.purchase_rules())
    return R.outcomes(spark, RAW_PURCHASE, f"{folder}/out", "Quantity").withColumnRenamed("Quantity", "quantity")


def inferred_schema(spark, d):
    """Types of the columns of purchase files, and the values that refuse narrower ones;
    the files come in two loads whose states are merged."""
    folder = scratch_folder(spark, "infer")
    rows = feeds.faulty_purchases(spark, d)
    even = F.coalesce(F.col("InvoiceNo").try_cast("bigint") % 2 == 0, F.lit(False))
    export_csv(rows.withColumn("load", F.when(even, 0).otherwise(1)), f"{folder}/in", partition_by=["load"], rows_per_file=ROWS_PER_FILE)
    return infer.with_types(infer.merge(*(infer.read_state(spark, f"{folder}/in/load={k}") for k in (0, 1))))


def load_metrics(spark, d):
    """Metrics of a purchase load, observed on its write: rows read, dropped, filled and kept, nulls of each column."""
    folder = scratch_folder(spark, "metrics")
    cleaned, rows = C.clean_observed(_w(spark, d).raw_purchases)
    cleaned, nulls = K.observe_nulls(cleaned)
    K.write_observed(cleaned, folder, "1", rows, nulls)
    return K.read_metrics(spark, folder).select("metric", "value")


def csv_export_reload(spark, d):
    """Whole review texts after their export to CSV files and the load of these into a table."""
    folder = scratch_folder(spark, "reload")
    docs = table(spark, d, "documents").select(*REVIEW_TEXT.names)
    export_csv(docs, f"{folder}/csv", rows_per_file=ROWS_PER_FILE)
    loaded = csv_to_table(spark, f"{folder}/csv", REVIEW_TEXT, f"reviews_{uuid.uuid4().hex}", path=f"{folder}/table")
    return loaded.select("doc_id", "lang", "source", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def insert_new_purchases(spark, d):
    staged = _w(spark, d).stg_user_purchase
    target = staged.where(F.col("invoice_number").try_cast("bigint") % 2 == 0)
    return C.insert_new(staged, target.select(*C.PURCHASE_KEY))


def insert_ignore_bucketed(spark, d):
    """A bucketed table of half the purchases after all of them are loaded into it, twice."""
    folder = scratch_folder(spark, "bucketed")
    staged = store(_w(spark, d).stg_user_purchase, "staged")      # the loads read one staged table
    name = f"purchases_{uuid.uuid4().hex}"
    B.create(staged.where(F.col("invoice_number").try_cast("bigint") % 2 == 0), name, path=folder)
    B.insert_ignore(staged, name)
    B.insert_ignore(staged, name)
    return spark.read.parquet(folder).select(*staged.columns)


def purchase_ids(spark, d):
    staged = _w(spark, d).stg_user_purchase
    return C.dense_serial_id(staged, ["invoice_number", "stock_code", "quantity", "unit_price"])


def purchase_ids_incremental(spark, d):
    """Ids of two appended batches; the second dies after its reservation and is
    appended again, and the first is appended once more."""
    folder = scratch_folder(spark, "ids")
    staged = store(_w(spark, d).stg_user_purchase, "staged")      # the appends read one staged table
    even = F.coalesce(F.col("invoice_number").try_cast("bigint") % 2 == 0, F.lit(False))
    order = ["invoice_number", "stock_code", "quantity", "unit_price"]
    first, second = staged.where(even), staged.where(~even)
    N.append_with_ids(first, folder, "1", order)
    try:
        N.append_with_ids(second, folder, "2", order, fail_before_write=True)
    except I.InjectedFailure:
        N.append_with_ids(second, folder, "2", order)
    N.append_with_ids(first, folder, "1", order)
    return N.read(spark, folder).drop("batch")


def fact_incremental(spark, d):
    """The fact after three folded batches, one of them folded twice, a compaction
    between, and a batch that the compaction already holds."""
    folder = scratch_folder(spark, "fact")
    w = _w(spark, d)

    def fold(k):
        part = {"purchases": F.crc32(F.col("invoice_number").cast("binary")), "reviews": F.col("review_id"), "logs": F.col("log_id")}
        tables = {"purchases": w.stg_user_purchase, "reviews": w.stg_classified_movie_review, "logs": w.stg_review_logs}
        return inc.fold(folder, str(k), **{n: t.where(F.pmod(part[n], F.lit(3)) == k) for n, t in tables.items()})

    fold(0)
    fold(1)
    fold(1)
    inc.compact(spark, folder)
    if fold(0):
        raise RuntimeError("a compacted batch was folded again")
    fold(2)
    return _fact_out(inc.fact(spark, folder))


NB_FOLDS = 5


def review_sentiment_nb(spark, d):
    """Naive Bayes sentiment of all reviews, learned outside fold 0 of 5."""
    texts = feeds.review_texts(spark, d).select("cid", "id_review", "review_str", "label")
    held = F.pmod("id_review", F.lit(NB_FOLDS)) == 0
    scored = bayes.classify(texts, bayes.fit(texts.where(~held)))
    return S.classify_output_to_flag(scored).select(
        F.col("id_review").alias("review_id"), F.col("cid").alias("user_id"), held.alias("held_out"), "sentiment",
        "positive_review", "margin")


def classify_reviews_ml(spark, d):
    from reelstar.operators.classify import classify_reviews
    texts = feeds.review_texts(spark, d)
    return classify_reviews(texts)


QUERIES: dict[str, Query] = {
    "clean_user_purchase": clean_user_purchase,
    "drop_missing_customer": drop_missing_customer,
    "fill_missing_text": fill_missing_text,
    "parse_invoice_date": parse_invoice_date,
    "cleaning_metrics": cleaning_metrics,
    "stg_user_purchase": stg_user_purchase,
    "review_logs_parsed": review_logs_parsed,
    "stg_review_logs": stg_review_logs,
    "positive_review_flag": positive_review_flag,
    "classified_movie_review": classified_movie_review,
    "stg_classified_movie_review": stg_classified_movie_review,
    "season_of_date": season_of_date,
    "surrogate_keys": surrogate_keys,
    "page_titles": page_titles,
    **{n: _dim_query(n, M.INTENT) for n in ("dim_date", *M.DIMS)},
    **{f"{n}_asis": _dim_query(n, M.AS_WRITTEN) for n in ("dim_date", *M.DIMS)},
    "customer_spend": customer_spend,
    "review_scores": review_scores,
    "purchases_with_reviews": purchases_with_reviews,
    "fact_movie_analytics": fact_movie_analytics,
    "fact_movie_analytics_asis": fact_movie_analytics_asis,
    "fact_clustered_readback": fact_clustered_readback,
    "q1_reviews_by_state_device": q1,
    "q2_positive_by_location": q2,
    "q3_revenue_sentiment": q3,
    "q5_device_by_region": q5,
    "q6_top_spenders": q6,
    "q7_positive_trend": q7,
    "q7_positive_trend_asis": q7_asis,
    "q8_avg_spend_by_state": q8,
    "m1_reviews_by_location": m1,
    "m2_reviews_by_device_region": m2,
    "m3_extreme_states": m3,
    "m4_device_share": m4,
    "m5_sentiment_trend": m5,
    "m6_most_positive": m6,
    "m7_spend_sentiment_corr": m7,
    "m8_revenue_positive": m8,
    "dq_not_null": _dq(Q.NOT_NULL),
    "dq_unique": _dq(Q.UNIQUE),
    "dq_relationships": _dq(Q.RELATIONSHIPS),
    "dq_accepted_values": _dq(Q.ACCEPTED_VALUES),
    "dq_report": _dq(None),
    "dq_report_asis": _dq(None, M.AS_WRITTEN),
    "ingest_new_files": ingest_new_files,
    "ledger_merge": ledger_merge,
    "insert_new_purchases": insert_new_purchases,
    "insert_ignore_bucketed": insert_ignore_bucketed,
    "purchase_ids": purchase_ids,
    "classify_reviews_ml": classify_reviews_ml,
    "review_sentiment_nb": review_sentiment_nb,
    "ingest_files_roundtrip": ingest_files_roundtrip,
    "purchase_ids_incremental": purchase_ids_incremental,
    "fact_incremental": fact_incremental,
    "load_rejects": load_rejects,
    "inferred_schema": inferred_schema,
    "load_metrics": load_metrics,
    "csv_export_reload": csv_export_reload,
}

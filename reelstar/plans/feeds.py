"""The three raw feeds, derived from the driver's Parquet tables.

This is the only module that knows the table and column names of the test
data; everything downstream sees the feed schemas of ``reelstar.schemas``.
The rules (which rows get nulls, tag values, id mapping) are fixed so that an
independent SQL text can rebuild the same feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.sources.files import table

# Fixed values of the mapping.
PRICE_FAULT_EVERY = 41               # StockCode % 41 = 0 -> UnitPrice is no number (faulty feed only)
DATE_FAULT_EVERY = 53                # InvoiceNo % 53 = 0 -> InvoiceDate is no date (faulty feed only)
DESCRIPTION_NULL_EVERY = 50          # p_partkey % 50 = 0 -> Description missing
CUSTOMER_NULL_LINE = 7               # l_linenumber = 7 -> CustomerID missing
LOG_ID_NULL_EVERY = 97               # event_id % 97 = 0 -> id_review missing
REVIEWS_PER_USER = 2                 # cid = doc_id div 2
DAY_ZERO = "2024-01-01"              # start of the synthetic calendars
DAYS = 365
DEVICES = ("Mobile", "Tablet", "Computer")
OPERATING_SYSTEMS = ("iOS", "Linux", "Windows", "Android", "macOS")
LOCATIONS = 25                       # location = NATION_<user_id % 25>
PHONE_DIGITS = 10
NO_LOCATION_EVENT = "error"          # events of this type carry no <location>


def raw_purchases(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw purchase feed: one row per line item, CSV-typed columns.

    The order side is enriched with customer and nation first (order-sized
    work), so the line items are shuffled only twice: once on the order key,
    once on the part key.  Line items and orders are both fact-sized, so that
    join is pinned to a sort-merge join: without statistics the planner
    estimates a joined side as the product of its inputs and would otherwise
    broadcast the line items.
    """
    li = table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    # the invoice text is a property of the order: format it once per order,
    # before the order rows are multiplied by their line items
    orders = table(spark, data_dir, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("o_invoice_text"))
    part = table(spark, data_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = table(spark, data_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, data_dir, "nation").select("n_nationkey", "n_name")

    buyers = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    orders = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    rows = (li.hint("merge").join(orders, li.l_orderkey == orders.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey))
    return rows.select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("p_partkey") % DESCRIPTION_NULL_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_name")).alias("Description"),
        F.col("l_quantity").cast("bigint").alias("Quantity"),
        F.col("o_invoice_text").alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.when(F.col("l_linenumber") == CUSTOMER_NULL_LINE, F.lit(None).cast("double"))
         .otherwise(F.col("o_custkey").cast("double")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def faulty_purchases(spark: SparkSession, data_dir: str) -> DataFrame:
    """The purchase feed as text, with prices and dates that do not parse."""
    def every(column: str, n: int):
        return F.coalesce(F.col(column).try_cast("bigint") % n == 0, F.lit(False))

    return (raw_purchases(spark, data_dir)
            .withColumn("UnitPrice", F.when(every("StockCode", PRICE_FAULT_EVERY), "n/a").otherwise(F.col("UnitPrice").cast("string")))
            .withColumn("InvoiceDate", F.when(every("InvoiceNo", DATE_FAULT_EVERY), "unknown").otherwise(F.col("InvoiceDate"))))


def _calendar_day(id_col: str):
    return F.date_add(F.lit(DAY_ZERO).cast("date"), (F.col(id_col) % DAYS).cast("int"))


def raw_reviews(spark: SparkSession, data_dir: str, with_text: bool = True) -> DataFrame:
    """Raw review feed plus the classifier's annotation array.

    Labelled documents carry ``['negative']`` (quality 0) or ``['positive']``;
    unlabelled ones carry null, which the flag rule turns into positive.
    ``insert_date`` stands for the classification time of each review.
    """
    docs = table(spark, data_dir, "documents")
    cols = ["doc_id", "text"] if with_text else ["doc_id"]
    labels = table(spark, data_dir, "labels").select("doc_id", "quality")
    joined = docs.select(*cols).join(labels, "doc_id", "left")
    out = [
        F.expr(f"doc_id div {REVIEWS_PER_USER}").alias("cid"),
    ]
    if with_text:
        out.append(F.col("text").alias("review_str"))
    out += [
        F.col("doc_id").alias("id_review"),
        F.when(F.col("quality") == 0, F.array(F.lit("negative")))
         .when(F.col("quality") == 1, F.array(F.lit("positive")))
         .alias("sentiment"),
        _calendar_day("doc_id").cast("timestamp_ntz").alias("insert_date"),
    ]
    return joined.select(*out)


def review_texts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Review texts with their labels (the classifier's training material)."""
    docs = table(spark, data_dir, "documents").select("doc_id", "text")
    labels = table(spark, data_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        F.expr(f"doc_id div {REVIEWS_PER_USER}").alias("cid"),
        F.col("text").alias("review_str"),
        F.col("doc_id").alias("id_review"),
        F.when(F.col("quality") == 0, F.lit("negative"))
         .when(F.col("quality") == 1, F.lit("positive")).alias("label"),
        _calendar_day("doc_id").cast("timestamp_ntz").alias("insert_date"),
    )


def _tag(name: str, value) -> F.Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def raw_logs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw log feed: (id_review, logs) with one XML fragment per event."""
    ev = table(spark, data_dir, "events").select("event_id", "user_id", "event_type")
    eid = F.col("event_id")
    octet = lambda shift: F.shiftright(eid, shift).bitwiseAND(255).cast("string")
    location = F.when(F.col("event_type") == NO_LOCATION_EVENT, F.lit("")).otherwise(
        _tag("location", F.concat(F.lit("NATION_"), (F.col("user_id") % LOCATIONS).cast("string"))))
    xml = F.concat(
        F.lit("<log>"),
        _tag("logDate", F.date_format(_calendar_day("event_id"), "yyyy-MM-dd")),
        _tag("device", F.element_at(F.array(*[F.lit(d) for d in DEVICES]),
                                     (eid % len(DEVICES) + 1).cast("int"))),
        _tag("os", F.element_at(F.array(*[F.lit(o) for o in OPERATING_SYSTEMS]),
                                 (eid % len(OPERATING_SYSTEMS) + 1).cast("int"))),
        location,
        _tag("ipAddress", F.concat_ws(".", F.lit("10"), octet(16), octet(8), octet(0))),
        _tag("phoneNumber", F.lpad(eid.cast("string"), PHONE_DIGITS, "0")),
        F.lit("</log>"),
    )
    return ev.select(
        F.when(eid % LOG_ID_NULL_EVERY == 0, F.lit(None).cast("bigint")).otherwise(eid).alias("id_review"),
        xml.alias("logs"),
    )


def review_sources(spark: SparkSession, data_dir: str) -> DataFrame:
    """Review ids with the source that sent them (the folder of its files)."""
    return table(spark, data_dir, "documents").select(
        F.expr(f"doc_id div {REVIEWS_PER_USER}").alias("cid"), F.col("doc_id").alias("id_review"), "source")

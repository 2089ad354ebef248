"""Declared schemas of the three raw feeds and of the staged tables."""

from pyspark.sql import types as T

# Raw purchase feed as a CSV reader with a declared schema sees it.  CustomerID
# is read as double because exports write ids such as ``17850.0``.
RAW_PURCHASE = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.DoubleType()),
    T.StructField("Country", T.StringType()),
])

# Raw purchase header -> cleaned column name.
PURCHASE_RENAMES = {
    "InvoiceNo": "invoice_number",
    "StockCode": "stock_code",
    "Description": "detail",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

# Fixed value: text form of InvoiceDate.
INVOICE_DATE_FORMAT = "M/d/yyyy H:mm"

RAW_REVIEW = T.StructType([
    T.StructField("cid", T.IntegerType()),
    T.StructField("review_str", T.StringType()),
    T.StructField("id_review", T.IntegerType()),
])

RAW_LOG = T.StructType([
    T.StructField("id_review", T.IntegerType()),
    T.StructField("logs", T.StringType()),
])

STG_USER_PURCHASE = T.StructType([
    T.StructField("invoice_number", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", T.DecimalType(8, 3)),
    T.StructField("customer_id", T.LongType()),
    T.StructField("country", T.StringType()),
])

STG_CLASSIFIED_REVIEW = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("positive_review", T.IntegerType()),
    T.StructField("review_id", T.LongType()),
    T.StructField("insert_date", T.TimestampNTZType()),
])

# XML tag -> parsed column of the review logs.
LOG_TAGS = {
    "logDate": "log_date",
    "device": "device",
    "os": "os",
    "location": "location",
    "ipAddress": "ip",
    "phoneNumber": "phone_number",
}
# Documented but absent from the feed; extracted on request (dim_browser).
BROWSER_TAG = ("browser", "browser")

LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

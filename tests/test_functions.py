import datetime as dt

from pyspark.sql import functions as F

from reelstar.functions import (array_to_text, parse_date, parse_invoice_ts, season,
                                sentiment_flag, surrogate_key, xml_tag)


def test_xml_tag_first_match_newline_absent_null(spark):
    df = spark.createDataFrame(
        [("<os>iOS</os><os>Linux</os>",), ("<os>i\nOS</os>",), ("<device>x</device>",), (None,)],
        "logs string")
    got = [r[0] for r in df.select(xml_tag("logs", "os")).collect()]
    assert got == ["iOS", "", "", None]


def test_surrogate_key_matches_md5_of_text(spark):
    df = spark.createDataFrame([(17850, "a"), (None, "b")], "c bigint, d string")
    one, two = df.select(surrogate_key("c"), surrogate_key("c", "d")).collect()
    assert one[0] == "ebdbcb5360801434b7014fcb108f6998"
    import hashlib
    assert one[1] == hashlib.md5(b"17850-a").hexdigest()
    assert two[0] == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()


def test_season_by_month_null_is_winter(spark):
    rows = [(dt.date(2024, m, 1),) for m in (2, 3, 6, 9, 12)] + [(None,)]
    df = spark.createDataFrame(rows, "d date")
    assert [r[0] for r in df.select(season("d")).collect()] == [
        "Winter", "Spring", "Summer", "Fall", "Winter", "Winter"]


def test_parse_invoice_ts_coerces_bad_text(spark):
    df = spark.createDataFrame([("12/1/2010 8:26",), ("bad",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(parse_invoice_ts("s")).collect()]
    assert got == [dt.datetime(2010, 12, 1, 8, 26), None, None, None]


def test_parse_date_tries_formats_in_order(spark):
    df = spark.createDataFrame([("2024-01-05",), ("01-05-2024",), ("junk",)], "s string")
    assert [r[0] for r in df.select(parse_date("s")).collect()] == [
        dt.date(2024, 1, 5), dt.date(2024, 1, 5), None]


def test_sentiment_only_exact_negative_is_zero(spark):
    df = spark.createDataFrame(
        [(["negative"],), (["negative", "negative"],), ([],), (None,), (["neutral"],), (["positive"],)],
        "a array<string>")
    got = [r[0] for r in df.select(sentiment_flag(array_to_text("a"))).collect()]
    assert got == [0, 1, 1, 1, 1, 1]
    texts = [r[0] for r in df.select(array_to_text("a")).collect()]
    assert texts[1] == "negative,negative" and texts[2] == "" and texts[3] == ""


def test_parse_invoice_ts_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:   # 2:30 does not exist in New York on that day, 1:30 in November exists twice
        df = spark.createDataFrame([("3/10/2024 2:30",), ("11/3/2024 1:30",), ("7/1/1890 0:05",)], "s string")
        got = [r[0] for r in df.select(parse_invoice_ts("s").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "1890-07-01 00:05:00"]

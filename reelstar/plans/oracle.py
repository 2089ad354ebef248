"""Independent SQL (DuckDB dialect) for every checkable query.

Written straight from the definitions, the naive way: the as-written marts
really join and fan out here, so the pre-aggregated Spark plans are checked
against the literal semantics.  Tables are the data folder's views.
"""

from __future__ import annotations

from reelstar.operators import quality as Q

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _tag(col: str, tag: str) -> str:
    return f"regexp_extract({col}, '<{tag}>(.*?)</{tag}>', 1)"


# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_purchases": ((), """
        SELECT CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
               CAST(l.l_partkey AS VARCHAR) AS StockCode,
               CASE WHEN p.p_partkey % 50 = 0 THEN NULL ELSE p.p_name END AS Description,
               CAST(l.l_quantity AS BIGINT) AS Quantity,
               strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate,
               p.p_retailprice AS UnitPrice,
               CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS CustomerID,
               n.n_name AS Country
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "user_purchase": (("raw_purchases",), """
        SELECT coalesce(InvoiceNo, '') AS invoice_number,
               coalesce(StockCode, '') AS stock_code,
               coalesce(Description, '') AS detail,
               Quantity AS quantity,
               try_strptime(coalesce(InvoiceDate, ''), '%m/%d/%Y %H:%M') AS invoice_date,
               CAST(UnitPrice AS DECIMAL(8,3)) AS unit_price,
               CAST(CustomerID AS BIGINT) AS customer_id,
               coalesce(Country, '') AS country
        FROM raw_purchases
        WHERE CustomerID IS NOT NULL"""),
    "stg_user_purchase": (("user_purchase",), """
        SELECT invoice_number, stock_code, detail,
               CAST(quantity AS BIGINT) AS quantity,
               CAST(invoice_date AS TIMESTAMP) AS invoice_date,
               CAST(unit_price AS DECIMAL(8,3)) AS unit_price,
               CAST(customer_id AS BIGINT) AS customer_id,
               country
        FROM user_purchase
        WHERE invoice_number IS NOT NULL AND stock_code IS NOT NULL AND quantity IS NOT NULL
          AND invoice_date IS NOT NULL AND unit_price IS NOT NULL AND customer_id IS NOT NULL
          AND country IS NOT NULL"""),
    "raw_reviews": ((), """
        SELECT d.doc_id // 2 AS cid,
               d.doc_id AS id_review,
               CASE WHEN lb.quality = 0 THEN ['negative']
                    WHEN lb.quality = 1 THEN ['positive'] END AS sentiment,
               CAST(DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS TIMESTAMP) AS insert_date
        FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id"""),
    "flagged_reviews": (("raw_reviews",), """
        SELECT cid, id_review, insert_date,
               coalesce(array_to_string(sentiment, ','), '') AS sentiment_text
        FROM raw_reviews"""),
    "classified_movie_review": (("flagged_reviews",), """
        SELECT CAST(cid AS BIGINT) AS user_id,
               CAST(CASE WHEN sentiment_text = 'negative' THEN 0 ELSE 1 END AS INTEGER) AS positive_review,
               CAST(id_review AS BIGINT) AS review_id,
               insert_date
        FROM flagged_reviews"""),
    "stg_classified_movie_review": (("classified_movie_review",), """
        SELECT * FROM classified_movie_review"""),
    "raw_logs": ((), """
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS id_review,
               '<log>'
               || '<logDate>' || strftime(DATE '2024-01-01' + CAST(event_id % 365 AS INTEGER), '%Y-%m-%d') || '</logDate>'
               || '<device>' || (['Mobile', 'Tablet', 'Computer'])[event_id % 3 + 1] || '</device>'
               || '<os>' || (['iOS', 'Linux', 'Windows', 'Android', 'macOS'])[event_id % 5 + 1] || '</os>'
               || CASE WHEN event_type = 'error' THEN ''
                       ELSE '<location>NATION_' || CAST(user_id % 25 AS VARCHAR) || '</location>' END
               || '<ipAddress>10.' || CAST((event_id >> 16) & 255 AS VARCHAR) || '.'
                  || CAST((event_id >> 8) & 255 AS VARCHAR) || '.' || CAST(event_id & 255 AS VARCHAR)
                  || '</ipAddress>'
               || '<phoneNumber>' || lpad(CAST(event_id AS VARCHAR), 10, '0') || '</phoneNumber>'
               || '</log>' AS logs
        FROM events"""),
    "review_logs": (("raw_logs",), f"""
        SELECT CAST(id_review AS BIGINT) AS log_id,
               {_tag('logs', 'logDate')} AS log_date,
               {_tag('logs', 'device')} AS device,
               {_tag('logs', 'os')} AS os,
               {_tag('logs', 'location')} AS location,
               {_tag('logs', 'ipAddress')} AS ip,
               {_tag('logs', 'phoneNumber')} AS phone_number,
               {_tag('logs', 'browser')} AS browser
        FROM raw_logs"""),
    "stg_review_logs": (("review_logs",), """
        SELECT * FROM review_logs WHERE log_id IS NOT NULL"""),
    "log_review_pairs": (("stg_review_logs", "stg_classified_movie_review"), """
        SELECT rl.*, mr.user_id AS user_id
        FROM stg_review_logs rl
        JOIN stg_classified_movie_review mr ON rl.log_id = mr.user_id"""),
}

_DATE = ("CAST(coalesce(try_strptime(log_date, '%Y-%m-%d'), try_strptime(log_date, '%m-%d-%Y')) AS DATE)")
_SEASON = """CASE WHEN month(d) BETWEEN 3 AND 5 THEN 'Spring'
                  WHEN month(d) BETWEEN 6 AND 8 THEN 'Summer'
                  WHEN month(d) BETWEEN 9 AND 11 THEN 'Fall'
                  ELSE 'Winter' END"""

DIM_COLUMNS = {
    "dim_devices": ("id_dim_devices", "device"),
    "dim_location": ("id_dim_location", "location"),
    "dim_os": ("id_dim_os", "os"),
    "dim_ip": ("id_dim_ip", "ip"),
    "dim_phone_number": ("id_dim_phone_number", "phone_number"),
    "dim_browser": ("id_dim_browser", "browser"),
}

for _suffix, _distinct in (("", "DISTINCT "), ("_aw", "")):
    for _name, (_key, _attr) in DIM_COLUMNS.items():
        CTES[_name + _suffix] = (("log_review_pairs",), f"""
        SELECT {_distinct}{_sk('log_id')} AS {_key}, {_attr}, user_id FROM log_review_pairs""")
    CTES["dim_date" + _suffix] = (("log_review_pairs",), f"""
        SELECT {_distinct}{_sk('log_id')} AS id_dim_date, d AS log_date,
               CAST(day(d) AS BIGINT) AS day, CAST(month(d) AS BIGINT) AS month,
               CAST(year(d) AS BIGINT) AS year, {_SEASON} AS season, user_id
        FROM (SELECT *, {_DATE} AS d FROM log_review_pairs) t""")

CTES["fact_movie_analytics"] = (
    ("stg_user_purchase", "stg_classified_movie_review", "dim_devices", "dim_location", "dim_os"), f"""
    SELECT {_sk('s.customer_id')} AS fact_key, s.customer_id,
           dd.id_dim_devices, dl.id_dim_location, dos.id_dim_os,
           s.amount_spent, r.review_score, r.review_count, r.insert_date
    FROM (SELECT customer_id, sum(quantity * unit_price) AS amount_spent
          FROM stg_user_purchase GROUP BY customer_id) s
    JOIN (SELECT user_id, CAST(sum(positive_review) AS BIGINT) AS review_score,
                 count(review_id) AS review_count, max(insert_date) AS insert_date
          FROM stg_classified_movie_review GROUP BY user_id) r ON s.customer_id = r.user_id
    LEFT JOIN (SELECT user_id, min(id_dim_devices) AS id_dim_devices FROM dim_devices GROUP BY user_id) dd
           ON dd.user_id = s.customer_id
    LEFT JOIN (SELECT user_id, min(id_dim_location) AS id_dim_location FROM dim_location GROUP BY user_id) dl
           ON dl.user_id = s.customer_id
    LEFT JOIN (SELECT user_id, min(id_dim_os) AS id_dim_os FROM dim_os GROUP BY user_id) dos
           ON dos.user_id = s.customer_id""")

CTES["fact_movie_analytics_aw"] = (
    ("stg_user_purchase", "stg_classified_movie_review", "dim_devices_aw", "dim_location_aw", "dim_os_aw"), f"""
    SELECT {_sk('up.customer_id')} AS fact_key, up.customer_id,
           dd.id_dim_devices, dl.id_dim_location, dos.id_dim_os,
           sum(up.quantity * up.unit_price) AS amount_spent,
           CAST(sum(mr.positive_review) AS BIGINT) AS review_score,
           count(mr.review_id) AS review_count,
           mr.insert_date
    FROM stg_user_purchase up
    JOIN stg_classified_movie_review mr ON up.customer_id = mr.user_id
    LEFT JOIN dim_devices_aw dd ON mr.user_id = dd.user_id
    LEFT JOIN dim_location_aw dl ON mr.user_id = dl.user_id
    LEFT JOIN dim_os_aw dos ON mr.user_id = dos.user_id
    GROUP BY 1, 2, 3, 4, 5, 9""")


def _resolve(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def sql(uses: tuple[str, ...], select: str) -> str:
    ctes = _resolve(uses)
    if not ctes:
        return select.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in ctes)
    select = select.strip()
    if select.upper().startswith("WITH "):
        return f"WITH {body},\n{select[5:]}"
    return f"WITH {body}\n{select}"


AS_WRITTEN_TABLES = {**{n: n + "_aw" for n in ("dim_date", *DIM_COLUMNS)},
                     "fact_movie_analytics": "fact_movie_analytics_aw"}


def _dq_one(check: Q.Check, tables: dict[str, str] | None = None) -> str:
    head = f"SELECT '{check.model}' AS model, '{check.column}' AS \"column\", '{check.test}' AS test, "
    tables = tables or {}
    t, c = tables.get(check.model, check.model), check.column
    if check.test == Q.NOT_NULL:
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM {t} WHERE {c} IS NULL"
    if check.test == Q.UNIQUE:
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {t} "
                       f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x")
    if check.test == Q.RELATIONSHIPS:
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM {t} ch "
                       f"LEFT JOIN {check.to} pa ON ch.{c} = pa.{check.field} "
                       f"WHERE ch.{c} IS NOT NULL AND pa.{check.field} IS NULL")
    values = ", ".join(str(v) for v in check.values)
    return head + (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {t} "
                   f"WHERE {c} IS NOT NULL AND {c} NOT IN ({values}) GROUP BY {c}) x")


DQ_MODELS = ("user_purchase", "classified_movie_review", "review_logs", "stg_review_logs",
             "stg_classified_movie_review", "stg_user_purchase", "dim_date", "dim_devices",
             "dim_ip", "dim_location", "dim_os", "dim_phone_number", "fact_movie_analytics")


def dq_sql(kind: str | None, as_written: bool = False) -> str:
    checks = Q.DECLARED_SUITE if kind is None else Q.checks_of_kind(kind)
    tables = AS_WRITTEN_TABLES if as_written else {}
    used = {c.model for c in checks} | {c.to for c in checks if c.to}
    used = tuple(sorted(tables.get(m, m) for m in used))
    return sql(used, "\nUNION ALL\n".join(_dq_one(c, tables) for c in checks))


_MONEY = "CAST({} AS DOUBLE)"
_STAR_LOC = "JOIN dim_location l ON f.id_dim_location = l.id_dim_location"
_STAR_DEV = "JOIN dim_devices d ON f.id_dim_devices = d.id_dim_devices"
_FACT_OUT = """SELECT fact_key, customer_id, id_dim_devices, id_dim_location, id_dim_os,
       CAST(amount_spent AS DOUBLE) AS amount_spent, review_score, review_count, insert_date FROM {}"""


def _dims(suffix: str, sel_suffix: str = "") -> dict[str, str]:
    out = {}
    for name in ("dim_date", *DIM_COLUMNS):
        out[name + sel_suffix] = sql((name + suffix,), f"SELECT * FROM {name}{suffix}")
    return out


# a text of the purchase files -> the condition under which it fits a kind of type
_FITS = {
    "bigint": "regexp_full_match(v, '[+-]?[0-9]{{1,18}}')",
    "double": "regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')",
    "timestamp_ntz": "v IS NULL OR try_strptime(v, '%m/%d/%Y %H:%M') IS NOT NULL",
    "boolean": "lower(v) IN ('true', 'false')",
}
_FILE_TEXT = {
    "InvoiceNo": "InvoiceNo", "StockCode": "StockCode", "Description": "Description", "Quantity": "CAST(Quantity AS VARCHAR)",
    "InvoiceDate": "CASE WHEN CAST(InvoiceNo AS BIGINT) % 53 = 0 THEN 'unknown' ELSE InvoiceDate END",
    "UnitPrice": "CASE WHEN CAST(StockCode AS BIGINT) % 41 = 0 THEN 'n/a' ELSE CAST(UnitPrice AS VARCHAR) END",
    "CustomerID": "CAST(CustomerID AS VARCHAR)", "Country": "Country",
}
_INFERRED = f"""
        WITH v AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, {e} AS v FROM raw_purchases" for c, e in _FILE_TEXT.items())}),
        s AS (SELECT column_name, count(*) AS n_rows, count(*) - count(v) AS n_null,
              {", ".join(f"count(*) FILTER (WHERE NOT ({f})) AS not_{k}, min(v) FILTER (WHERE NOT ({f})) AS bad_{k}" for k, f in _FITS.items())}
              FROM v GROUP BY column_name)
        SELECT *, CASE WHEN n_rows = n_null THEN 'string' {" ".join(f"WHEN not_{k} = 0 THEN '{k}'" for k in _FITS)} ELSE 'string' END AS column_type
        FROM s""".replace("{{", "{").replace("}}", "}")
_PURCHASE_COLUMNS = ("invoice_number", "stock_code", "detail", "quantity", "invoice_date", "unit_price", "customer_id", "country")
_METRICS = """
        SELECT 'rows_in' AS metric, count(*) AS value FROM raw_purchases
        UNION ALL SELECT 'dropped_missing_customer', count(*) FROM raw_purchases WHERE CustomerID IS NULL
        UNION ALL SELECT 'rows_out', count(*) FROM raw_purchases WHERE CustomerID IS NOT NULL
        UNION ALL SELECT 'filled_values', CAST(sum((InvoiceNo IS NULL)::INT + (StockCode IS NULL)::INT + (Description IS NULL)::INT
                                                   + (InvoiceDate IS NULL)::INT + (Country IS NULL)::INT) AS BIGINT)
                  FROM raw_purchases WHERE CustomerID IS NOT NULL""" + "".join(
    f" UNION ALL SELECT 'nulls_{c}', count(*) FROM user_purchase WHERE {c} IS NULL" for c in _PURCHASE_COLUMNS)

ORACLE: dict[str, str] = {
    "clean_user_purchase": sql(("user_purchase",), "SELECT * FROM user_purchase"),
    "drop_missing_customer": sql(("raw_purchases",), "SELECT * FROM raw_purchases WHERE CustomerID IS NOT NULL"),
    "fill_missing_text": sql(("raw_purchases",), """
        SELECT coalesce(InvoiceNo, '') AS InvoiceNo, coalesce(StockCode, '') AS StockCode,
               coalesce(Description, '') AS Description, Quantity,
               coalesce(InvoiceDate, '') AS InvoiceDate, UnitPrice, CustomerID,
               coalesce(Country, '') AS Country
        FROM raw_purchases WHERE CustomerID IS NOT NULL"""),
    "parse_invoice_date": sql(("raw_purchases",), """
        SELECT InvoiceNo AS invoice_number, StockCode AS stock_code, InvoiceDate AS invoice_date_text,
               try_strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS invoice_date
        FROM raw_purchases"""),
    "cleaning_metrics": sql(("raw_purchases",), """
        SELECT count(*) AS rows_in,
               count(*) FILTER (WHERE CustomerID IS NULL) AS dropped_missing_customer,
               CAST(count(*) FILTER (WHERE CustomerID IS NOT NULL AND InvoiceNo IS NULL)
                  + count(*) FILTER (WHERE CustomerID IS NOT NULL AND StockCode IS NULL)
                  + count(*) FILTER (WHERE CustomerID IS NOT NULL AND Description IS NULL)
                  + count(*) FILTER (WHERE CustomerID IS NOT NULL AND InvoiceDate IS NULL)
                  + count(*) FILTER (WHERE CustomerID IS NOT NULL AND Country IS NULL) AS BIGINT) AS filled_values,
               count(*) FILTER (WHERE CustomerID IS NOT NULL) AS rows_out
        FROM raw_purchases"""),
    "stg_user_purchase": sql(("stg_user_purchase",), "SELECT * FROM stg_user_purchase"),
    "review_logs_parsed": sql(("review_logs",), """
        SELECT log_id, log_date, device, os, location, ip, phone_number FROM review_logs"""),
    "stg_review_logs": sql(("stg_review_logs",), """
        SELECT log_id, log_date, device, os, location, ip, phone_number FROM stg_review_logs"""),
    "positive_review_flag": sql(("flagged_reviews",), """
        SELECT id_review AS review_id, sentiment_text AS sentiment,
               CAST(CASE WHEN sentiment_text = 'negative' THEN 0 ELSE 1 END AS INTEGER) AS positive_review
        FROM flagged_reviews"""),
    "classified_movie_review": sql(("classified_movie_review",), "SELECT * FROM classified_movie_review"),
    "stg_classified_movie_review": sql(("stg_classified_movie_review",),
                                       "SELECT * FROM stg_classified_movie_review"),
    "season_of_date": sql(("stg_review_logs",), f"""
        SELECT log_id, d AS log_date, {_SEASON} AS season
        FROM (SELECT log_id, {_DATE} AS d FROM stg_review_logs) t"""),
    "surrogate_keys": sql(("stg_user_purchase",), f"""
        SELECT DISTINCT invoice_number, stock_code, customer_id,
               {_sk('invoice_number', 'stock_code')} AS purchase_key,
               {_sk('customer_id')} AS customer_key
        FROM stg_user_purchase"""),
    "page_titles": sql((), f"SELECT page_id, {_tag('html', 'title')} AS title FROM pages"),
    **_dims(""),
    **_dims("_aw", "_asis"),
    "customer_spend": sql(("stg_user_purchase",), """
        SELECT customer_id, CAST(sum(quantity * unit_price) AS DOUBLE) AS amount_spent
        FROM stg_user_purchase GROUP BY customer_id"""),
    "review_scores": sql(("stg_classified_movie_review",), """
        SELECT user_id, CAST(sum(positive_review) AS BIGINT) AS review_score, count(review_id) AS review_count
        FROM stg_classified_movie_review GROUP BY user_id"""),
    "purchases_with_reviews": sql(("stg_user_purchase", "stg_classified_movie_review"), """
        SELECT p.invoice_number, p.stock_code, p.customer_id, p.quantity, p.unit_price,
               r.review_count, r.positive_reviews
        FROM stg_user_purchase p
        JOIN (SELECT user_id, count(review_id) AS review_count,
                     CAST(sum(positive_review) AS BIGINT) AS positive_reviews
              FROM stg_classified_movie_review GROUP BY user_id) r
          ON p.customer_id = r.user_id"""),
    "fact_movie_analytics": sql(("fact_movie_analytics",), _FACT_OUT.format("fact_movie_analytics")),
    "fact_clustered_readback": sql(("fact_movie_analytics",), _FACT_OUT.format("fact_movie_analytics")),
    "fact_movie_analytics_asis": sql(("fact_movie_analytics_aw",), _FACT_OUT.format("fact_movie_analytics_aw")),
    "q1_reviews_by_state_device": sql(("fact_movie_analytics", "dim_location", "dim_devices"), f"""
        SELECT l.location AS state, d.device, count(f.review_count) AS total_reviews
        FROM fact_movie_analytics f {_STAR_LOC} {_STAR_DEV}
        WHERE l.location IN ('NATION_1', 'NATION_2', 'NATION_3')
        GROUP BY l.location, d.device ORDER BY total_reviews DESC"""),
    "q2_positive_by_location": sql(("fact_movie_analytics", "dim_location"), f"""
        SELECT l.location AS state, CAST(sum(f.review_score) AS BIGINT) AS positive_reviews
        FROM fact_movie_analytics f {_STAR_LOC}
        GROUP BY l.location ORDER BY positive_reviews DESC"""),
    "q3_revenue_sentiment": sql(("fact_movie_analytics",), """
        SELECT f.customer_id, CAST(sum(f.amount_spent) AS DOUBLE) AS total_spent,
               CAST(sum(f.review_score) AS BIGINT) AS total_positive_reviews
        FROM fact_movie_analytics f GROUP BY f.customer_id ORDER BY total_spent DESC"""),
    "q5_device_by_region": sql(("fact_movie_analytics", "dim_location", "dim_devices"), f"""
        SELECT l.location AS region, d.device, count(f.review_count) AS review_count
        FROM fact_movie_analytics f {_STAR_LOC} {_STAR_DEV}
        GROUP BY l.location, d.device ORDER BY review_count DESC"""),
    "q6_top_spenders": sql(("fact_movie_analytics",), """
        SELECT f.customer_id, CAST(sum(f.amount_spent) AS DOUBLE) AS total_spent
        FROM fact_movie_analytics f GROUP BY f.customer_id
        ORDER BY total_spent DESC, f.customer_id LIMIT 10"""),
    "q7_positive_trend": sql(("fact_movie_analytics", "dim_date"), """
        SELECT d.year, d.month, CAST(sum(f.review_score) AS BIGINT) AS positive_reviews
        FROM fact_movie_analytics f
        JOIN (SELECT DISTINCT log_date, year, month FROM dim_date) d
          ON CAST(f.insert_date AS DATE) = d.log_date
        GROUP BY d.year, d.month ORDER BY d.year, d.month"""),
    "q7_positive_trend_asis": sql(("fact_movie_analytics_aw", "dim_date_aw"), """
        SELECT d.year, d.month, CAST(sum(f.review_score) AS BIGINT) AS positive_reviews
        FROM fact_movie_analytics_aw f
        JOIN dim_date_aw d ON f.insert_date = d.log_date
        GROUP BY d.year, d.month ORDER BY d.year, d.month"""),
    "q8_avg_spend_by_state": sql(("fact_movie_analytics", "dim_location"), f"""
        SELECT l.location AS state,
               CAST(sum(f.amount_spent) AS DOUBLE) / count(f.amount_spent) AS avg_spending
        FROM fact_movie_analytics f {_STAR_LOC}
        GROUP BY l.location ORDER BY avg_spending DESC"""),
    "m1_reviews_by_location": sql(("fact_movie_analytics", "dim_location"), f"""
        SELECT l.location, CAST(sum(f.review_count) AS BIGINT) AS total_reviews
        FROM fact_movie_analytics f {_STAR_LOC} GROUP BY l.location"""),
    "m2_reviews_by_device_region": sql(("fact_movie_analytics", "dim_location", "dim_devices"), f"""
        SELECT l.location AS region, d.device, CAST(sum(f.review_count) AS BIGINT) AS total_reviews
        FROM fact_movie_analytics f {_STAR_LOC} {_STAR_DEV} GROUP BY l.location, d.device"""),
    "m3_extreme_states": sql(("fact_movie_analytics", "dim_location"), f"""
        WITH t AS (SELECT l.location AS state, CAST(sum(f.review_count) AS BIGINT) AS total_reviews
                   FROM fact_movie_analytics f {_STAR_LOC} GROUP BY l.location)
        SELECT * FROM (SELECT 'highest' AS extreme, state, total_reviews FROM t
                       ORDER BY total_reviews DESC, state LIMIT 1)
        UNION ALL
        SELECT * FROM (SELECT 'lowest' AS extreme, state, total_reviews FROM t
                       ORDER BY total_reviews ASC, state LIMIT 1)"""),
    "m4_device_share": sql(("fact_movie_analytics", "dim_location", "dim_devices"), f"""
        WITH c AS (SELECT l.location AS region, d.device, CAST(sum(f.review_count) AS BIGINT) AS reviews
                   FROM fact_movie_analytics f {_STAR_LOC} {_STAR_DEV} GROUP BY l.location, d.device),
             t AS (SELECT region, sum(reviews) AS total FROM c GROUP BY region)
        SELECT c.region, c.device, c.reviews, c.reviews / CAST(t.total AS DOUBLE) AS share
        FROM c JOIN t ON c.region = t.region"""),
    "m5_sentiment_trend": sql(("stg_classified_movie_review",), """
        SELECT CAST(year(insert_date) AS BIGINT) AS year, CAST(month(insert_date) AS BIGINT) AS month,
               CAST(sum(positive_review) AS BIGINT) AS positive_reviews,
               CAST(sum(1 - positive_review) AS BIGINT) AS negative_reviews
        FROM stg_classified_movie_review GROUP BY 1, 2"""),
    "m6_most_positive": sql(("fact_movie_analytics", "dim_location", "dim_devices"), f"""
        WITH j AS (SELECT l.location, d.device, f.review_score, f.review_count
                   FROM fact_movie_analytics f {_STAR_LOC} {_STAR_DEV})
        SELECT dimension, value, positive_reviews, total_reviews,
               positive_reviews / CAST(total_reviews AS DOUBLE) AS positive_rate
        FROM (SELECT 'location' AS dimension, location AS value,
                     CAST(sum(review_score) AS BIGINT) AS positive_reviews,
                     CAST(sum(review_count) AS BIGINT) AS total_reviews FROM j GROUP BY location
              UNION ALL
              SELECT 'device', device, CAST(sum(review_score) AS BIGINT),
                     CAST(sum(review_count) AS BIGINT) FROM j GROUP BY device) u"""),
    "m7_spend_sentiment_corr": sql(("fact_movie_analytics",), """
        SELECT round(corr(CAST(amount_spent AS DOUBLE), CAST(review_score AS DOUBLE)), 6)
               AS corr_spend_sentiment
        FROM fact_movie_analytics"""),
    "m8_revenue_positive": sql(("fact_movie_analytics",), """
        SELECT count(*) AS positive_customers, CAST(sum(amount_spent) AS DOUBLE) AS revenue_positive
        FROM fact_movie_analytics WHERE review_score > 0"""),
    "dq_not_null": dq_sql(Q.NOT_NULL),
    "dq_unique": dq_sql(Q.UNIQUE),
    "dq_relationships": dq_sql(Q.RELATIONSHIPS),
    "dq_accepted_values": dq_sql(Q.ACCEPTED_VALUES),
    "dq_report": dq_sql(None),
    "dq_report_asis": dq_sql(None, as_written=True),
    "ingest_new_files": sql((), """
        SELECT DISTINCT 'source=' || source AS path FROM documents
        WHERE NOT coalesce(TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) % 2 = 0, false)"""),
    "ledger_merge": sql((), "SELECT DISTINCT 'source=' || source AS path FROM documents"),
    "ingest_files_roundtrip": sql(("review_logs",), """
        SELECT log_id, log_date, device, os, location, ip, phone_number FROM review_logs"""),
    "fact_incremental": sql(("fact_movie_analytics",), _FACT_OUT.format("fact_movie_analytics")),
    "purchase_ids_incremental": sql(("stg_user_purchase",), """
        WITH p AS (SELECT *, coalesce(TRY_CAST(invoice_number AS BIGINT) % 2 = 0, false) AS early FROM stg_user_purchase)
        SELECT row_number() OVER (ORDER BY NOT early, invoice_number, stock_code, quantity, unit_price) AS id,
               * EXCLUDE (early)
        FROM p"""),
    "review_sentiment_nb": sql((), r"""
        WITH r AS (SELECT d.doc_id AS review_id, d.doc_id // 2 AS user_id, d.doc_id % 5 = 0 AS held_out,
                          coalesce(d.text, '') AS t, CASE lb.quality WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' END AS label
                   FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id),
             words AS (SELECT review_id, held_out, label, unnest(regexp_extract_all(t,
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+')) AS token FROM r),
             counts AS (SELECT token, count(*) FILTER (WHERE label = 'negative') AS n0,
                               count(*) FILTER (WHERE label = 'positive') AS n1
                        FROM words WHERE NOT held_out AND label IS NOT NULL GROUP BY token),
             total AS (SELECT count(*) AS v, sum(n0) AS t0, sum(n1) AS t1 FROM counts),
             weights AS (SELECT token, CAST(round(ln((n0 + 1) / CAST(t0 + v AS DOUBLE)), 8) AS DECIMAL(28,8)) AS w0,
                                CAST(round(ln((n1 + 1) / CAST(t1 + v AS DOUBLE)), 8) AS DECIMAL(28,8)) AS w1
                         FROM counts, total),
             priors AS (SELECT CAST(round(ln(count(*) FILTER (WHERE label = 'negative') / CAST(count(*) AS DOUBLE)), 8) AS DECIMAL(28,8)) AS p0,
                               CAST(round(ln(count(*) FILTER (WHERE label = 'positive') / CAST(count(*) AS DOUBLE)), 8) AS DECIMAL(28,8)) AS p1
                        FROM r WHERE NOT held_out AND label IS NOT NULL),
             sums AS (SELECT review_id, sum(w0) AS s0, sum(w1) AS s1 FROM words JOIN weights USING (token) GROUP BY review_id),
             scored AS (SELECT review_id, user_id, held_out, coalesce(s0, 0) + p0 AS s0, coalesce(s1, 0) + p1 AS s1
                        FROM r LEFT JOIN sums USING (review_id), priors)
        SELECT review_id, user_id, held_out, CASE WHEN s0 >= s1 THEN 'negative' ELSE 'positive' END AS sentiment,
               CAST(CASE WHEN s0 >= s1 THEN 0 ELSE 1 END AS INTEGER) AS positive_review, CAST(abs(s0 - s1) AS DOUBLE) AS margin
        FROM scored"""),
    "load_rejects": sql(("raw_purchases",), """
        WITH o AS (SELECT Quantity, CASE WHEN CAST(StockCode AS BIGINT) % 41 = 0 THEN 'malformed field'
                                         WHEN CustomerID IS NULL THEN 'missing customer'
                                         WHEN CAST(InvoiceNo AS BIGINT) % 53 = 0 THEN 'bad invoice date' ELSE '' END AS reason
                   FROM raw_purchases)
        SELECT CASE reason WHEN '' THEN 'kept' WHEN 'missing customer' THEN 'dropped' ELSE 'rejected' END AS outcome, reason,
               count(*) AS n_rows, CAST(sum(Quantity) AS BIGINT) AS quantity
        FROM o GROUP BY reason
        UNION ALL SELECT 'read', '', count(*), CAST(sum(Quantity) AS BIGINT) FROM o"""),
    "inferred_schema": sql(("raw_purchases",), _INFERRED),
    "load_metrics": sql(("raw_purchases", "user_purchase"), _METRICS),
    "csv_export_reload": "SELECT doc_id, lang, source, length(text) AS n_chars, md5(text) AS text_md5 FROM documents",
    "insert_new_purchases": sql(("stg_user_purchase",), """
        SELECT invoice_number, stock_code, detail, quantity, invoice_date, unit_price, customer_id, country
        FROM (SELECT *, row_number() OVER (PARTITION BY invoice_number, stock_code
                                           ORDER BY invoice_date, quantity, unit_price, detail,
                                                    customer_id, country) AS rn
              FROM stg_user_purchase) t
        WHERE rn = 1 AND NOT coalesce(TRY_CAST(invoice_number AS BIGINT) % 2 = 0, false)"""),
    "insert_ignore_bucketed": sql(("stg_user_purchase",), """
        SELECT invoice_number, stock_code, detail, quantity, invoice_date, unit_price, customer_id, country
        FROM (SELECT *, row_number() OVER (PARTITION BY invoice_number, stock_code
                                           ORDER BY invoice_date, quantity, unit_price, detail,
                                                    customer_id, country) AS rn
              FROM stg_user_purchase) t
        WHERE rn = 1"""),
    "purchase_ids": sql(("stg_user_purchase",), """
        SELECT row_number() OVER (ORDER BY invoice_number, stock_code, quantity, unit_price) AS id, *
        FROM stg_user_purchase"""),
}

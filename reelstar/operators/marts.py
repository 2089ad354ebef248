"""Star-schema marts: six (seven) dimensions and the customer fact.

Two modes:

* ``intent`` -- the documented grain: dims are distinct, the fact has one row
  per customer with spend and reviews aggregated *before* they meet.
* ``as_written`` -- the declared SQL taken literally: a dim row per
  (log, review) pair and a fact grouped after a fan-out join.

Neither mode materialises the fan-out.  A dim row of the as-written join only
carries values of its log (``user_id`` equals ``log_id`` by the join), so it
is the log row repeated once per review of that user: the dims are built as
``logs x review-count`` with a weight, and the as-written fact is computed
from per-key aggregates multiplied by those weights.  The results are exact,
the work is linear in the inputs, and a user that holds a third of all
reviews is reduced map-side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.functions import amount, parse_date, season, surrogate_key, DEFAULT_DATE_FORMATS

INTENT = "intent"
AS_WRITTEN = "as_written"
MODES = (INTENT, AS_WRITTEN)
WEIGHT = "_n"

# Dimension name -> (surrogate key column, attribute columns).
DIMS = {
    "dim_devices": ("id_dim_devices", ("device",)),
    "dim_location": ("id_dim_location", ("location",)),
    "dim_os": ("id_dim_os", ("os",)),
    "dim_ip": ("id_dim_ip", ("ip",)),
    "dim_phone_number": ("id_dim_phone_number", ("phone_number",)),
    "dim_browser": ("id_dim_browser", ("browser",)),
}
DATE_KEY = "id_dim_date"

# Review column a log id is matched to: the declared join uses the user id.
USER_KEY = "user_id"
LOG_JOIN_KEYS = (USER_KEY, "review_id")

# Copies of one row emitted by a single generator call before a re-split.
REPLICATE_CHUNK = 1 << 16


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


def review_users(reviews: DataFrame) -> DataFrame:
    """Distinct reviewing users (partial aggregation collapses hot users map-side)."""
    return reviews.select("user_id").where(F.col("user_id").isNotNull()).distinct()


def review_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per user -- the multiplicity of the as-written (log, review) join."""
    return reviews.groupBy("user_id").agg(F.count(F.lit(1)).alias(WEIGHT))


def replicate(df: DataFrame, weight: str = WEIGHT, chunk: int = REPLICATE_CHUNK) -> DataFrame:
    """Repeat each row ``weight`` times (drops the weight column).

    Copies are made in two steps: first one row per chunk of at most
    ``chunk`` copies, re-spread over the cluster, then the copies inside each
    chunk -- so a single heavy row does not have to be expanded by one task.
    """
    cols = [c for c in df.columns if c != weight]
    n = F.col(weight)
    starts = F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(chunk).cast("bigint"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = df.where(n > 0).select(*cols, n.alias("_w"), F.explode(starts).alias("_c0")).repartition(parts)
    copies = F.least(F.lit(chunk).cast("bigint"), F.col("_w") - F.col("_c0"))
    return chunks.select(*cols, F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("_r")).select(*cols)


def _dim_rows(logs: DataFrame, reviews: DataFrame, key_name: str, attrs: Sequence, mode: str,
              weighted: bool, log_join_key: str = USER_KEY) -> DataFrame:
    proj = [surrogate_key("log_id").alias(key_name), *attrs]
    if log_join_key == USER_KEY:
        # declared join: log_id = user_id, so the dim's user_id is the log id
        proj.append(F.col("log_id").alias("user_id"))
        if mode == INTENT:
            users = review_users(reviews).withColumnRenamed("user_id", "log_id")
            return logs.join(users, "log_id", "left_semi").select(*proj).distinct()
        counts = review_counts(reviews).withColumnRenamed("user_id", "log_id")
    else:
        # log_id = review_id: the user comes from the matched review
        proj.append(F.col("user_id"))
        counts = (reviews.where(F.col(log_join_key).isNotNull())
                  .groupBy(F.col(log_join_key).alias("log_id"), "user_id")
                  .agg(F.count(F.lit(1)).alias(WEIGHT)))
        if mode == INTENT:
            return logs.join(counts, "log_id").select(*proj).distinct()
    rows = logs.join(counts, "log_id").select(*proj, F.col(WEIGHT))
    return rows if weighted else replicate(rows)


def build_dim(logs: DataFrame, reviews: DataFrame, attr_cols: Sequence[str], key_name: str,
              mode: str = INTENT, weighted: bool = False, log_join_key: str = USER_KEY) -> DataFrame:
    """Dimension of log attributes for logs that match a review.

    ``logs`` is ``stg_review_logs``; ``reviews`` is
    ``stg_classified_movie_review``.  ``log_join_key`` is the review column
    the log id is matched to: ``user_id`` as declared, or ``review_id``.
    With ``weighted=True`` the as-written form keeps one row per (log, user)
    and a ``_n`` multiplicity column instead of repeating rows.
    """
    _check_mode(mode)
    if log_join_key not in LOG_JOIN_KEYS:
        raise ValueError(f"log_join_key must be one of {LOG_JOIN_KEYS}")
    return _dim_rows(logs, reviews, key_name, [F.col(c) for c in attr_cols], mode, weighted, log_join_key)


def named_dim(name: str, logs: DataFrame, reviews: DataFrame, mode: str = INTENT,
              weighted: bool = False, log_join_key: str = USER_KEY) -> DataFrame:
    key, attrs = DIMS[name]
    return build_dim(logs, reviews, attrs, key, mode, weighted, log_join_key)


def dim_date(logs: DataFrame, reviews: DataFrame, mode: str = INTENT, weighted: bool = False,
             date_formats: Sequence[str] = DEFAULT_DATE_FORMATS, log_join_key: str = USER_KEY) -> DataFrame:
    """Date dimension: parsed log date, day/month/year (bigint), season."""
    _check_mode(mode)
    if log_join_key not in LOG_JOIN_KEYS:
        raise ValueError(f"log_join_key must be one of {LOG_JOIN_KEYS}")
    d = parse_date("log_date", date_formats)
    attrs = [
        d.alias("log_date"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.month(d).cast("bigint").alias("month"),
        F.year(d).cast("bigint").alias("year"),
        season(d).alias("season"),
    ]
    return _dim_rows(logs, reviews, DATE_KEY, attrs, mode, weighted, log_join_key)


FACT_DIMS = ("dim_devices", "dim_location", "dim_os")
LOG_KEY = "_log_key"


def log_keys(logs: DataFrame, reviews: DataFrame, mode: str = INTENT,
             log_join_key: str = USER_KEY) -> DataFrame:
    """The key every dim gives a reviewed user's log: (user_id, _log_key[, _n]).

    All dims come from one builder keyed by ``md5(log_id)``, so the three
    foreign keys of the fact are one lookup; joining it once replaces three
    dim builds that differ only in the attribute the fact never reads.
    """
    _check_mode(mode)
    if mode == INTENT and log_join_key != USER_KEY:
        raise ValueError("the intent fact holds one log key per customer: join the logs on user_id, "
                         "or use the as-written fact, which keeps every key")
    if mode == INTENT:
        # a reviewed user's log ids are the user id: distinct numbers, hashed afterwards
        users = logs.join(review_users(reviews).withColumnRenamed("user_id", "log_id"), "log_id", "left_semi")
        return users.select(F.col("log_id").alias("user_id")).distinct().withColumn(LOG_KEY, surrogate_key("user_id"))
    return _dim_rows(logs, reviews, LOG_KEY, [], mode, weighted=True, log_join_key=log_join_key)


LOGS = "_n_logs"


def star_rows(logs: DataFrame, reviews: DataFrame, names: Sequence[str]) -> DataFrame:
    """``user_id``, the attributes of several dims and the number of logs that share them: one pass over the logs."""
    attrs = [a for n in names for a in DIMS[n][1]]
    users = review_users(reviews).withColumnRenamed("user_id", "log_id")
    return (logs.join(users, "log_id", "left_semi").groupBy(F.col("log_id").alias("user_id"), *attrs)
            .agg(F.count(F.lit(1)).alias(LOGS)))


def star_dims(rows: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The intent dims of ``names`` and, as ``LOG_KEY``, the fact's key lookup, all from the same ``star_rows``.

    Their columns hang on the count, so the planner can neither drop that
    aggregate nor push a filter below it: all of them read one exchange.
    """
    def dim(key: str, attrs: Sequence[str]) -> DataFrame:
        some = F.col(LOGS) > 0
        return rows.select(F.when(some, F.col("user_id")).alias("user_id"), *(F.when(some, F.col(a)).alias(a) for a in attrs)
                           ).distinct().withColumn(key, surrogate_key("user_id"))
    return {n: dim(*DIMS[n]) for n in names} | {LOG_KEY: dim(LOG_KEY, ())}


def _dim_key_per_user(dim: DataFrame, key: str) -> DataFrame:
    """One key per user; ``min`` keeps the fact at one row per customer even if
    a user ever had logs under several keys.  ``log_keys`` has one already."""
    if key == LOG_KEY:
        return dim.select("user_id", key)
    return dim.groupBy("user_id").agg(F.min(key).alias(key))


def _join_dim_keys(fact: DataFrame, dims: dict[str, DataFrame], per_user) -> DataFrame:
    """Left-join each distinct dim frame once (frames passed under several
    names are joined once and their key is copied to each name)."""
    groups: dict[int, list[str]] = {}
    frames: dict[int, DataFrame] = {}
    for name in FACT_DIMS:
        groups.setdefault(id(dims[name]), []).append(name)
        frames[id(dims[name])] = dims[name]
    for ident, names in groups.items():
        frame = frames[ident]
        src = LOG_KEY if LOG_KEY in frame.columns else DIMS[names[0]][0]
        looked_up = per_user(frame, src).withColumnRenamed("user_id", "customer_id")
        fact = fact.join(looked_up, "customer_id", "left")
        extra = [c for c in looked_up.columns if c not in ("customer_id", src)]
        fact = fact.select(*[c for c in fact.columns if c != src and c not in extra],
                           *[F.col(src).alias(DIMS[n][0]) for n in names], *extra)
    return fact


def fact_intent(purchases: DataFrame, reviews: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row per customer with purchases and reviews.

    Spend and review measures are aggregated per customer first, so the join
    is one-to-one; ``insert_date`` is the latest classification time.
    ``dims`` maps dim_devices / dim_location / dim_os to the dim frames (or
    one shared ``log_keys`` frame).
    """
    spend = purchases.groupBy("customer_id").agg(
        F.sum(amount("quantity", "unit_price")).alias("amount_spent"))
    scores = reviews.groupBy("user_id").agg(
        F.sum("positive_review").cast("bigint").alias("review_score"),
        F.count("review_id").alias("review_count"),
        F.max("insert_date").alias("insert_date"),
    )
    fact = spend.join(scores, spend.customer_id == scores.user_id).drop("user_id")
    fact = _join_dim_keys(fact, dims, _dim_key_per_user)
    return fact.select(
        surrogate_key("customer_id").alias("fact_key"),
        "customer_id", "id_dim_devices", "id_dim_location", "id_dim_os",
        "amount_spent", "review_score", "review_count", "insert_date",
    )


def fact_as_written(purchases: DataFrame, reviews: DataFrame,
                    weighted_dims: dict[str, DataFrame]) -> DataFrame:
    """The declared fact: purchases x reviews, left-joined to three dims, grouped
    by (fact_key, customer, three dim keys, insert_date).

    Each output group is the product of independent per-key groups, so every
    measure is a per-side aggregate times the row counts of the other sides:

    * amount_spent = spend(c) x reviews(c, t) x w_dev x w_loc x w_os
    * review_score = positives(c, t) x purchases(c) x w_dev x w_loc x w_os
    * review_count = review ids(c, t) x purchases(c) x w_dev x w_loc x w_os

    where ``w`` is the as-written dim row count of that user and key (1 when
    the left join finds nothing).  Decimal sums stay exact.
    """
    spend = purchases.groupBy("customer_id").agg(
        F.sum(amount("quantity", "unit_price")).alias("_spend"),
        F.count(F.lit(1)).alias("_np"),
    )
    per_day = reviews.groupBy("user_id", "insert_date").agg(
        F.sum("positive_review").cast("bigint").alias("_pos"),
        F.count("review_id").alias("_nid"),
        F.count(F.lit(1)).alias("_nr"),
    )
    fact = spend.join(per_day, spend.customer_id == per_day.user_id).drop("user_id")
    weights = []
    per_frame: dict[int, DataFrame] = {}
    for name in FACT_DIMS:
        # every dim is joined even when one shared frame serves all three: a
        # user with several log keys gets the declared cross product of keys.
        # A shared frame's per-key weights are one DataFrame joined under an
        # alias and renamed only after the join, so the three joins have
        # identical inputs and Spark reuses one exchange for them.
        frame = weighted_dims[name]
        key = DIMS[name][0]
        src = LOG_KEY if LOG_KEY in frame.columns else key
        if id(frame) not in per_frame:
            per_frame[id(frame)] = (frame.groupBy("user_id", src).agg(F.sum(WEIGHT).alias("_w"))
                                    .withColumnRenamed("user_id", "customer_id"))
        side = per_frame[id(frame)].alias(f"_{name}")
        w = f"_w_{name}"
        kept = [F.col(c) for c in fact.columns]
        fact = fact.join(side, "customer_id", "left").select(
            *kept, F.col(f"_{name}.{src}").alias(key), F.col(f"_{name}._w").alias(w))
        weights.append(F.coalesce(F.col(w), F.lit(1)))
    mult = weights[0] * weights[1] * weights[2]
    return fact.select(
        surrogate_key("customer_id").alias("fact_key"),
        "customer_id", "id_dim_devices", "id_dim_location", "id_dim_os",
        (F.col("_spend") * F.col("_nr") * mult).alias("amount_spent"),
        (F.col("_pos") * F.col("_np") * mult).cast("bigint").alias("review_score"),
        (F.col("_nid") * F.col("_np") * mult).cast("bigint").alias("review_count"),
        "insert_date",
    )

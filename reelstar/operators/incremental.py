"""The customer fact kept up to date batch by batch.

A batch of purchases, reviews and logs becomes one small table of mergeable
per-customer totals (exact decimal sum, counts, latest date) and one of the log
ids seen.  Totals merge by sum and max, in any order, so the fact after a batch
is the merge of what was folded so far: no earlier purchase, review or log is
read again.

Layout below a state folder::

    customers/batch=<name>, logs/batch=<name>     one batch's totals (overwritten by a retry)
    base/<version>/customers, base/<version>/logs the merge of the batches it lists
    commits                                       (version, batch): append-only

A compaction writes a new base and then commits the batches it contains; until
the commit row exists, readers use the older base and the single batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.functions import amount, surrogate_key
from reelstar.sources.ledger import create_table

COMMITS = "version int, batch string"
CUSTOMERS = ("customer_id bigint, spend decimal(38,3), n_purchases bigint, review_score bigint, review_count bigint, "
             "n_reviews bigint, last_review timestamp_ntz")
LOGS = "log_id bigint"
KINDS = {"customers": CUSTOMERS, "logs": LOGS}


def customer_totals(purchases: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mergeable totals per customer of one batch of staged purchases and reviews.

    Each side is reduced per customer in every task before it is shuffled.
    """
    spend = purchases.groupBy("customer_id").agg(F.sum(amount("quantity", "unit_price")).cast("decimal(38,3)").alias("spend"),
                                                 F.count(F.lit(1)).alias("n_purchases"))
    scores = reviews.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.sum("positive_review").cast("bigint").alias("review_score"), F.count("review_id").alias("review_count"),
        F.count(F.lit(1)).alias("n_reviews"), F.max("insert_date").alias("last_review"))
    return merge(spend.unionByName(scores, allowMissingColumns=True))


def merge(totals: DataFrame) -> DataFrame:
    """Totals of all batches into one row per customer."""
    sums = {"spend": "decimal(38,3)", "n_purchases": "bigint", "review_score": "bigint", "review_count": "bigint", "n_reviews": "bigint"}
    return totals.where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        *(F.sum(c).cast(t).alias(c) for c, t in sums.items()), F.max("last_review").alias("last_review"))


def _commits(spark: SparkSession, path: str) -> DataFrame:
    create_table(spark, f"{path}/commits", COMMITS)
    return spark.read.schema(COMMITS).parquet(f"{path}/commits")


def _parts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The newest base and the batches it lacks."""
    create_table(spark, f"{path}/{kind}", f"{KINDS[kind]}, batch string", partition_by="batch")
    commits = _commits(spark, path)
    version = commits.agg(F.max("version")).first()[0]
    later = spark.read.schema(f"{KINDS[kind]}, batch string").parquet(f"{path}/{kind}")
    if version is None:
        return later.drop("batch")
    inside = commits.where(F.col("version") == version).select("batch")
    base = spark.read.schema(KINDS[kind]).parquet(f"{path}/base/{version}/{kind}")
    return base.unionByName(later.join(inside, "batch", "left_anti").drop("batch"))


def fold(path: str, batch: str, purchases: DataFrame, reviews: DataFrame, logs: DataFrame) -> bool:
    """Fold one batch into the state at ``path``; false if a compaction already holds it.

    Folding a batch again replaces what it left, so a retry counts once.
    """
    spark = purchases.sparkSession
    if _commits(spark, path).where(F.col("batch") == batch).limit(1).count():
        return False
    customer_totals(purchases, reviews).write.mode("overwrite").parquet(f"{path}/customers/batch={batch}")
    logs.where("log_id IS NOT NULL").select(F.col("log_id").cast("bigint").alias("log_id")).distinct().write.mode(
        "overwrite").parquet(f"{path}/logs/batch={batch}")
    return True


def compact(spark: SparkSession, path: str) -> int:
    """Merge the base and all single batches into a new base; its version.

    The batches merged are the folders that exist when it starts; their names
    (not their rows) pass through the driver.  A batch that lacks one of its two
    tables is a fold that died: it stays out until it has been folded again.
    """
    commits = _commits(spark, path)
    version = (commits.agg(F.max("version")).first()[0] or 0) + 1
    parts = {kind: _parts(spark, path, kind) for kind in KINDS}     # creates the tables
    done = commits.where(F.col("version") == version - 1).select("batch")
    folders = [_folders(spark, f"{path}/{kind}") for kind in KINDS]
    names = reduce(lambda a, b: a & b, folders)
    if set.union(*folders) - names:
        raise RuntimeError(f"batches to be folded again first: {sorted(set.union(*folders) - names)[:5]}")
    merge(parts["customers"]).write.mode("overwrite").parquet(f"{path}/base/{version}/customers")
    parts["logs"].distinct().write.mode("overwrite").parquet(f"{path}/base/{version}/logs")
    new = spark.createDataFrame([(n,) for n in sorted(names)], "batch string").unionByName(done).distinct()
    new.select(F.lit(version).alias("version"), "batch").coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return version


def _folders(spark: SparkSession, root: str) -> set[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(hpath) if s.isDirectory()]
    return {p.getName().split("=", 1)[1] for p in found if p.getName().startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))}


def fact(spark: SparkSession, path: str) -> DataFrame:
    """The intent fact from the state alone: customers with purchases and reviews.

    All dims are keyed by the log id, which is the customer's id, so the three
    dim keys need only know whether such a log was seen.
    """
    customers = merge(_parts(spark, path, "customers")).where("n_purchases > 0 AND n_reviews > 0")
    seen = _parts(spark, path, "logs").distinct().select(F.col("log_id").alias("customer_id"), F.lit(True).alias("seen"))
    key = F.when(F.col("seen"), surrogate_key("customer_id"))
    return customers.join(seen, "customer_id", "left").select(
        surrogate_key("customer_id").alias("fact_key"), "customer_id", key.alias("id_dim_devices"), key.alias("id_dim_location"),
        key.alias("id_dim_os"), F.col("spend").alias("amount_spent"), "review_score", "review_count",
        F.col("last_review").alias("insert_date"))

"""The daily jobs: load the three feeds, then build the marts.

* ``load_purchases``: CSV -> clean -> insert-ignore into the purchase table.
* ``load_reviews``: new review files only -> classify -> append.
* ``load_logs``: new log files only -> parse the XML tags -> append.
* ``build_marts``: staging -> dims -> fact, stored as tables.

Every step is a DataFrame plan executed on the cluster; only file names and
the small model pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.operators import clean as C
from reelstar.operators import marts as M
from reelstar.operators import staging as S
from reelstar.operators.classify import classify_reviews, load_or_fit
from reelstar.schemas import RAW_LOG, RAW_PURCHASE, RAW_REVIEW, STG_USER_PURCHASE
from reelstar.session import cut_lineage
from reelstar.sources.files import read_csv, read_csv_inferred
from reelstar.sources.sinks import create_table_if_absent, materialize
from reelstar.streaming.ingest import ingest_stream, ingest_with_ledger


def load_purchases(spark: SparkSession, paths, table: str = "user_purchase",
                   infer_schema: bool = False, metrics: dict | None = None) -> int:
    """Clean the purchase CSV and append the rows whose key the table lacks.

    Returns the number of rows appended; ``metrics`` (if given) receives the
    cleaning counts, observed while the rows are materialised.  The rows to
    insert are cut from their lineage (reliable checkpoint) before the
    append, because their plan reads the very table being appended to.
    """
    raw = read_csv_inferred(spark, paths) if infer_schema else read_csv(spark, paths, RAW_PURCHASE)
    if infer_schema:
        raw = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_PURCHASE.fields])
    clean, observation = C.clean_observed(raw)
    create_table_if_absent(spark, table, STG_USER_PURCHASE)
    new = cut_lineage(C.insert_new(clean, spark.table(table).select(*C.PURCHASE_KEY)))
    if metrics is not None:
        metrics.update(observation.get)
    n = new.count()
    new.write.mode("append").saveAsTable(table)
    return n


def load_reviews(spark: SparkSession, source_dir: str, ledger_path: str, sink_path: str,
                 model_dir: str | None = None, training: DataFrame | None = None,
                 batch_ts=None, stream: bool = False) -> int:
    """Classify the review files not yet processed and append them.

    ``training`` (cid, review_str, id_review, label) fits the model once when
    ``model_dir`` holds none; files are then scored with the saved model.
    Without ``model_dir`` it is fitted for this run and not saved.
    ``stream=True`` uses the file stream (``ledger_path`` is then its
    checkpoint folder) and returns the number of micro-batches.
    """
    model = None
    if training is not None:
        model = load_or_fit(spark, training.withColumnRenamed("review_str", "text")
                            .where(F.col("label").isNotNull()), model_dir)

    def transform(df: DataFrame) -> DataFrame:
        return classify_reviews(df, model_dir=model_dir, batch_ts=batch_ts, model=model)

    if stream:
        return ingest_stream(spark, source_dir, RAW_REVIEW, transform, sink_path, ledger_path,
                             multiline=True)
    return ingest_with_ledger(spark, source_dir, ledger_path, RAW_REVIEW, transform, sink_path,
                              multiline=True)


def load_logs(spark: SparkSession, source_dir: str, ledger_path: str, sink_path: str,
              stream: bool = False) -> int:
    """Parse the log files not yet processed and append them.

    ``stream=True`` uses the file stream (``ledger_path`` is then its
    checkpoint folder) and returns the number of micro-batches.
    """
    if stream:
        return ingest_stream(spark, source_dir, RAW_LOG, S.parse_review_logs, sink_path, ledger_path)
    return ingest_with_ledger(spark, source_dir, ledger_path, RAW_LOG, S.parse_review_logs, sink_path)


def build_marts(purchases: DataFrame, reviews: DataFrame, logs: DataFrame,
                mode: str = M.INTENT, prefix: str = "", store: bool = True,
                log_join_key: str = M.USER_KEY) -> dict[str, DataFrame]:
    """Staging -> six dims -> fact; stored as tables named ``{prefix}{mart}``.

    ``purchases`` is the purchase table, ``reviews`` the classified reviews,
    ``logs`` the parsed logs (null ids included).
    """
    stg_p = S.stg_user_purchase(purchases)
    stg_r = S.stg_classified_movie_review(reviews)
    stg_l = S.stg_review_logs(logs)
    out: dict[str, DataFrame] = {"dim_date": M.dim_date(stg_l, stg_r, mode, log_join_key=log_join_key)}
    for name in M.DIMS:
        if name == "dim_browser" and "browser" not in stg_l.columns:
            continue
        out[name] = M.named_dim(name, stg_l, stg_r, mode, log_join_key=log_join_key)
    keys = M.log_keys(stg_l, stg_r, mode, log_join_key=log_join_key)
    fact_dims = {n: keys for n in M.FACT_DIMS}
    out["fact_movie_analytics"] = (M.fact_intent(stg_p, stg_r, fact_dims) if mode == M.INTENT
                                   else M.fact_as_written(stg_p, stg_r, fact_dims))
    if store:
        out = {name: materialize(df, f"{prefix}{name}",
                                 sort_within=["customer_id"] if name.startswith("fact") else ["user_id"])
               for name, df in out.items()}
    return out

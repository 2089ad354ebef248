"""The warehouse over one data folder: staged tables, dims and facts as lazy
DataFrames.  Nothing here runs a job; each mart is a plan that Catalyst
prunes to the columns a query asks for.  A warehouse lists the files when it
is built: every query builds its own, so that it sees files added since."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from reelstar.operators import clean as C
from reelstar.operators import marts as M
from reelstar.operators import staging as S
from reelstar.plans import feeds


class Warehouse:
    def __init__(self, spark: SparkSession, data_dir: str, log_join_key: str = M.USER_KEY):
        self.spark = spark
        self.data_dir = data_dir
        self.log_join_key = log_join_key
        self._marts: dict[tuple, DataFrame] = {}

    # -- feeds ---------------------------------------------------------------
    @cached_property
    def raw_purchases(self) -> DataFrame:
        return feeds.raw_purchases(self.spark, self.data_dir)

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return feeds.raw_reviews(self.spark, self.data_dir, with_text=False)

    @cached_property
    def raw_logs(self) -> DataFrame:
        return feeds.raw_logs(self.spark, self.data_dir)

    # -- sources and staging -------------------------------------------------
    @cached_property
    def user_purchase(self) -> DataFrame:
        """The cleaned purchase table (source ``user_purchase``)."""
        return C.clean_user_purchase(self.raw_purchases)

    @cached_property
    def stg_user_purchase(self) -> DataFrame:
        return S.stg_user_purchase(self.user_purchase)

    @cached_property
    def classified_movie_review(self) -> DataFrame:
        return S.classified_movie_review(self.raw_reviews)

    @cached_property
    def stg_classified_movie_review(self) -> DataFrame:
        return self.classified_movie_review

    @cached_property
    def review_logs(self) -> DataFrame:
        """Parsed logs, null ids included (source ``review_logs``)."""
        return S.parse_review_logs(self.raw_logs, with_browser=True)

    @cached_property
    def stg_review_logs(self) -> DataFrame:
        return S.stg_review_logs(self.review_logs)

    # -- marts ---------------------------------------------------------------
    def dim(self, name: str, mode: str = M.INTENT, weighted: bool = False) -> DataFrame:
        key = ("dim", name, mode, weighted)
        if key not in self._marts:
            self._marts[key] = self._dim(name, mode, weighted)
        return self._marts[key]

    def _dim(self, name: str, mode: str, weighted: bool) -> DataFrame:
        logs, reviews = self.stg_review_logs, self.stg_classified_movie_review
        if name == "dim_date":
            return M.dim_date(logs, reviews, mode, weighted, log_join_key=self.log_join_key)
        return M.named_dim(name, logs, reviews, mode, weighted, log_join_key=self.log_join_key)

    def dims(self, mode: str = M.INTENT) -> dict[str, DataFrame]:
        return {n: self.dim(n, mode) for n in ("dim_date", *M.DIMS)}

    def star(self, *names: str) -> tuple[DataFrame, ...]:
        """The intent fact and the dims ``names`` from one scan of the logs, whose exchange they share."""
        rows = M.star_rows(self.stg_review_logs, self.stg_classified_movie_review, names)
        dims = M.star_dims(rows, names)
        fact = M.fact_intent(self.stg_user_purchase, self.stg_classified_movie_review, dict.fromkeys(M.FACT_DIMS, dims[M.LOG_KEY]))
        return fact, *(dims[n] for n in names)

    def fact(self, mode: str = M.INTENT, shared_keys: bool = True) -> DataFrame:
        key = ("fact", mode, shared_keys)
        if key not in self._marts:
            self._marts[key] = self._fact(mode, shared_keys)
        return self._marts[key]

    def _fact(self, mode: str, shared_keys: bool) -> DataFrame:
        """Customer fact.  With ``shared_keys`` the three dim keys come from one
        lookup of reviewed users' log keys (all dims share that key); without
        it each dim is built and joined on its own."""
        purchases, reviews = self.stg_user_purchase, self.stg_classified_movie_review
        logs = self.stg_review_logs
        if shared_keys:
            keys = M.log_keys(logs, reviews, mode, log_join_key=self.log_join_key)
            dims = {n: keys for n in M.FACT_DIMS}
        elif mode == M.INTENT:
            dims = {n: self.dim(n) for n in M.FACT_DIMS}
        else:
            dims = {n: self.dim(n, M.AS_WRITTEN, weighted=True) for n in M.FACT_DIMS}
        if mode == M.INTENT:
            return M.fact_intent(purchases, reviews, dims)
        return M.fact_as_written(purchases, reviews, dims)

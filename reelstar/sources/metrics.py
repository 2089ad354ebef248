"""Loads whose metrics come from the write itself, kept in a metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS = "load string, metric string, value long"


def observe_nulls(df: DataFrame, name: str = "nulls") -> tuple[DataFrame, Observation]:
    """``df`` and its null count per column, ``nulls_<column>``, seen by whatever action runs the plan."""
    seen = Observation(name)
    counts = [F.count_if(F.col("`" + c.replace("`", "``") + "`").isNull()).alias(f"nulls_{c}") for c in df.columns]
    return (df.observe(seen, *counts), seen) if counts else (df, seen)


def write_observed(df: DataFrame, path: str, load: str, *seen: Observation) -> None:
    """Write a load below ``path``/data and then its metrics below ``path``/metrics, each in the load's own folder.

    A repeated load overwrites both.  The data come first: a load without
    metrics has not ended.  Observe above the last shuffle only, where each task
    counts once however often an executor is lost.
    """
    df.write.mode("overwrite").parquet(f"{path}/data/load={load}")
    rows = [(load, metric, int(value)) for s in seen for metric, value in s.get.items()]
    df.sparkSession.createDataFrame(rows, METRICS).drop("load").coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics/load={load}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``load, metric, value`` of all loads."""
    return spark.read.schema(METRICS).parquet(f"{path}/metrics")

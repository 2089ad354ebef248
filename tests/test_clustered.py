"""Z-order layout: interleaving, skipped row groups, dynamic overwrite, odd inputs."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reelstar.sources import clustered as Z


def test_interleaving_equals_plain_python(spark):
    def plain(x, y):
        return sum((x >> k & 1) << 2 * k | (y >> k & 1) << (2 * k + 1) for k in range(3))

    rows = [(x, y) for x in range(8) for y in range(8)]
    df = spark.createDataFrame(rows, "x int, y int").select("x", "y", Z.interleaved([F.col("x"), F.col("y")], 3).alias("z"))
    assert {(r.x, r.y): r.z for r in df.collect()} == {p: plain(*p) for p in rows}


def _groups(path, column, low, high):
    """Row groups whose range of ``column`` meets [low, high], and all of them."""
    hit = total = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            at = next(c for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == column)
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit, total


def test_filters_on_each_column_skip_row_groups(spark, tmp_path):
    df = spark.range(20000).selectExpr("id", "pmod(hash(id), 1000) AS x", "pmod(hash(id, 1), 1000) / 8.0D AS y")
    path = str(tmp_path / "t")
    Z.write_clustered(df, path, ["x", "y"], files=16)
    for column, low, high in (("x", 500, 520), ("y", 60.0, 62.0)):
        hit, total = _groups(path, column, low, high)
        assert total >= 16 and 2 * hit <= total
    assert spark.read.parquet(path).exceptAll(df).count() == 0 and spark.read.parquet(path).count() == 20000


def test_hot_value_spreads_over_files(spark, tmp_path):
    df = spark.range(9000).selectExpr("id", "IF(id % 3 = 0, 7, CAST(id AS INT)) AS x", "1 AS y")
    path = str(tmp_path / "t")
    Z.write_clustered(df, path, ["x", "y"], files=9)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 9000 and max(sizes) <= 2000


def test_only_the_written_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    Z.write_clustered(spark.createDataFrame([(1, 10, 1), (1, 20, 2), (2, 30, 3), (None, 40, 4)], "k int, x int, y int"), path, ["x", "y"],
                      partition_by=["k"])
    Z.write_clustered(spark.createDataFrame([(1, 11, 1)], "k int, x int, y int"), path, ["x", "y"], partition_by=["k"])
    got = {(r.k, r.x, r.y) for r in spark.read.parquet(path).collect()}
    assert got == {(1, 11, 1), (2, 30, 3), (None, 40, 4)}


def test_nulls_empty_and_texts(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (1, None), (2, None)], "x int, y double")
    Z.write_clustered(df, str(tmp_path / "n"), ["x", "y"])
    assert sorted(spark.read.parquet(str(tmp_path / "n")).collect(), key=str) == sorted(df.collect(), key=str)
    Z.write_clustered(df.limit(0), str(tmp_path / "e"), ["x"])
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError):
        Z.write_clustered(spark.createDataFrame([("a",)], "t string"), str(tmp_path / "s"), ["t"])

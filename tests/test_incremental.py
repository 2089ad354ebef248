"""Ids and the customer fact kept up batch by batch: dense, unchanged, retry-safe, equal to the full build."""

import os

import pytest
from pyspark.sql import functions as F

from reelstar.operators import incremental as inc
from reelstar.operators import marts as M
from reelstar.operators import serial
from reelstar.plans.warehouse import Warehouse
from reelstar.streaming.ingest import InjectedFailure

SF = "/root/testdata/sf0.001"
ROW = "k string, v int, batch_note string"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), ROW).repartition(3)


def test_ids_stay_dense_and_old_ids_unchanged(spark, tmp_path):
    path = str(tmp_path / "t")
    assert serial.append_with_ids(_rows(spark, ("b", 1, None), ("a", 2, ""), ("a", 1, "x"), ("a", 1, "x")), path, "m1", ["k", "v"]) == 4
    first = {tuple(r) for r in serial.read(spark, path).collect()}
    assert sorted((r[0], r[1], r[2]) for r in first) == [(1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "b", 1)]
    with pytest.raises(InjectedFailure):
        serial.append_with_ids(_rows(spark, ("z", 1, None), ("c", 1, None)), path, "m2", ["k"], fail_before_write=True)
    assert {tuple(r) for r in serial.read(spark, path).collect()} == first        # nothing half written
    serial.append_with_ids(_rows(spark, ("a", 0, None)), path, "m3", ["k"])        # another batch comes in between
    serial.append_with_ids(_rows(spark, ("c", 1, None), ("z", 1, None)), path, "m2", ["k"])
    serial.append_with_ids(_rows(spark, ("c", 1, None), ("z", 1, None)), path, "m2", ["k"])
    after = {tuple(r) for r in serial.read(spark, path).collect()}
    assert first <= after and sorted(r[0] for r in after) == list(range(1, 8))
    assert {(r[0], r[1]) for r in after - first} == {(5, "c"), (6, "z"), (7, "a")}


def test_a_changed_or_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    serial.append_with_ids(_rows(spark, ("a", 1, None)), path, "m1", ["k"])
    with pytest.raises(ValueError):
        serial.append_with_ids(_rows(spark, ("a", 1, None), ("b", 1, None)), path, "m1", ["k"])
    assert serial.append_with_ids(_rows(spark, ("a", 1, None)).limit(0), path, "m2", ["k"]) == 0
    serial.append_with_ids(_rows(spark, ("c", 1, None)), path, "m3", ["k"])
    assert sorted(r.id for r in serial.read(spark, path).collect()) == [1, 2]


@pytest.fixture(scope="module")
def staged(spark):
    w = Warehouse(spark, SF)
    extra_r = spark.createDataFrame([(3, 1, None, None), (None, 1, 5, None)], "user_id long, positive_review int, review_id long, insert_date timestamp_ntz")
    extra_l = w.stg_review_logs.limit(2)
    return (w.stg_user_purchase.cache(), w.stg_classified_movie_review.unionByName(extra_r).cache(),
            w.stg_review_logs.unionByName(extra_l).cache())


def _part(staged, k, n=3):
    p, r, g = staged
    return (p.where(F.pmod(F.xxhash64("invoice_number"), F.lit(n)) == k), r.where(F.pmod(F.xxhash64("review_id"), F.lit(n)) == k),
            g.where(F.pmod(F.xxhash64("log_id"), F.lit(n)) == k))


def _full(staged):
    p, r, g = staged
    keys = M.log_keys(g, r)
    return sorted(map(repr, M.fact_intent(p, r, {n: keys for n in M.FACT_DIMS}).collect()))


def test_folded_batches_equal_the_full_fact(spark, staged, tmp_path):
    path = str(tmp_path / "state")
    for k in (0, 1, 1):
        assert inc.fold(path, f"b{k}", *_part(staged, k))
    assert inc.compact(spark, path) == 1
    assert not inc.fold(path, "b0", *_part(staged, 0))
    inc.fold(path, "b2", *_part(staged, 2))
    assert sorted(map(repr, inc.fact(spark, path).collect())) == _full(staged)
    assert inc.compact(spark, path) == 2 and inc.compact(spark, path) == 3
    assert not inc.fold(path, "b2", *_part(staged, 2))
    assert sorted(map(repr, inc.fact(spark, path).collect())) == _full(staged)


def test_order_of_batches_does_not_matter(spark, staged, tmp_path):
    path = str(tmp_path / "state")
    for k in (4, 0, 3, 1, 2):
        inc.fold(path, str(k), *_part(staged, k, 5))
    assert sorted(map(repr, inc.fact(spark, path).collect())) == _full(staged)


def test_a_fold_reads_the_batch_and_the_fact_reads_the_state(spark, staged, tmp_path):
    path = str(tmp_path / "state")
    for k in range(3):
        inc.fold(path, str(k), *_part(staged, k))
    plan = inc.fact(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "event_id" not in plan and "doc_id" not in plan
    one = inc.customer_totals(*_part(staged, 0)[:2])
    assert one.count() == one.select("customer_id").distinct().count()


def test_compaction_waits_for_a_fold_that_died(spark, staged, tmp_path):
    path = str(tmp_path / "state")
    inc.fold(path, "0", *_part(staged, 0))
    inc.customer_totals(*_part(staged, 1)[:2]).write.parquet(f"{path}/customers/batch=1")     # died before its logs
    with pytest.raises(RuntimeError, match="folded again"):
        inc.compact(spark, path)
    inc.fold(path, "1", *_part(staged, 1))
    inc.fold(path, "2", *_part(staged, 2))
    inc.compact(spark, path)
    assert not os.path.exists(f"{path}/base/2")
    assert sorted(map(repr, inc.fact(spark, path).collect())) == _full(staged)


def test_empty_state(spark, staged, tmp_path):
    path = str(tmp_path / "state")
    assert inc.fact(spark, path).count() == 0
    inc.fold(path, "0", *(t.limit(0) for t in staged))
    assert inc.fact(spark, path).count() == 0

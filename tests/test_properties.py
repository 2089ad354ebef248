"""Property tests for the chunked expansions: copies are exact for any
weights and chunk sizes; serial ids are dense and follow the order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelstar.operators import clean as C
from reelstar.operators import marts as M

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(weights=st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=12),
       chunk=st.integers(min_value=1, max_value=9))
def test_replicate_makes_exact_copies(spark, weights, chunk):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "k int, _n bigint")
    got = sorted(r.k for r in M.replicate(df, chunk=chunk).collect())
    assert got == sorted(i for i, w in enumerate(weights) for _ in range(w))


@SETTINGS
@given(keys=st.lists(st.integers(min_value=0, max_value=5), min_size=1, max_size=60),
       chunk=st.integers(min_value=1, max_value=7))
def test_dense_serial_id_is_a_permutation_in_order(spark, keys, chunk):
    df = spark.createDataFrame([(k, k % 2) for k in keys], "k int, v int").repartition(3)
    got = C.dense_serial_id(df, ["k"], chunk=chunk).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, len(keys) + 1))
    assert [(r.k, r.v) for r in got] == sorted((k, k % 2) for k in keys)

"""Types with evidence, observed metrics and CSV reload on small tables."""

from pyspark.sql import functions as F

from reelstar.sources import infer, metrics
from reelstar.sources.files import read_csv
from reelstar.sources.sinks import export_csv

COLS = "a string, b string, `c.d` string, e string, f string"
ROWS = [("1", "1.5", "true", None, "1/2/2020 3:04"), ("-22", "2e3", "FALSE", None, "12/31/2021 23:59"),
        (None, "x", "true", None, "1/1/2020 0:00"), ("9" * 18, ".5", "", None, None)]


def _state(df):
    return {r["column_name"]: r.asDict() for r in infer.with_types(df).collect()}


def test_types_and_evidence(spark):
    got = _state(infer.state_of(spark.createDataFrame(ROWS, COLS)))
    assert {k: v["column_type"] for k, v in got.items()} == {
        "a": "bigint", "b": "string", "c.d": "string", "e": "string", "f": "timestamp_ntz"}
    assert (got["a"]["n_rows"], got["a"]["n_null"], got["a"]["bad_boolean"]) == (4, 1, "-22")
    assert (got["b"]["not_bigint"], got["b"]["not_double"], got["b"]["bad_double"], got["b"]["bad_bigint"]) == (4, 1, "x", ".5")
    assert (got["c.d"]["not_boolean"], got["c.d"]["bad_boolean"]) == (1, "")
    assert (got["e"]["n_null"], got["e"]["not_bigint"], got["e"]["bad_bigint"]) == (4, 0, None)


def test_merged_states_equal_the_whole(spark):
    df = spark.createDataFrame(ROWS, COLS)
    parts = [df.where(F.col("b") == b) for b in ("1.5", "2e3", "x", ".5")]
    assert _state(infer.merge(*map(infer.state_of, parts))) == _state(infer.state_of(df))
    assert _state(infer.merge(infer.state_of(df), infer.state_of(df.where("false")))) == _state(infer.state_of(df))


def test_long_numbers_and_empty_tables(spark):
    big = spark.createDataFrame([("9" * 19,), ("1" * 400,), ("1\n",)], "n string")
    assert _state(infer.state_of(big))["n"]["column_type"] == "string"
    assert _state(infer.state_of(big.limit(1)))["n"]["column_type"] == "double"
    empty = _state(infer.state_of(big.where("false")))["n"]
    assert (empty["n_rows"], empty["not_bigint"], empty["column_type"]) == (0, 0, "string")
    assert infer.state_of(spark.createDataFrame([()], "struct<>")).count() == 0


def test_one_pass_and_a_schema_that_reads(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a,\"b\"\nc", True), (2, None, "", False)], "i long, x double, t string, b boolean")
    export_csv(df, f"{tmp_path}/in")
    state = infer.read_state(spark, f"{tmp_path}/in", multiline=True)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan
    schema = infer.inferred_schema(state, df.columns)
    assert schema == df.schema
    back = read_csv(spark, f"{tmp_path}/in", schema, multiline=True, keep_empty=True)
    assert sorted(back.collect()) == sorted(df.collect())


def test_metrics_of_a_write_and_of_its_repetition(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a long, `b c` string")
    for _ in range(2):
        out, seen = metrics.observe_nulls(df)
        metrics.write_observed(out, str(tmp_path / "m"), "7", seen)
    out, seen = metrics.observe_nulls(df.where("false"), "none")
    metrics.write_observed(out, str(tmp_path / "m"), "8", seen)
    got = {(r.load, r.metric): r.value for r in metrics.read_metrics(spark, str(tmp_path / "m")).collect()}
    assert got == {("7", "nulls_a"): 2, ("7", "nulls_b c"): 2, ("8", "nulls_a"): 0, ("8", "nulls_b c"): 0}
    assert spark.read.parquet(str(tmp_path / "m/data")).count() == 3


def test_each_value_is_parsed_once_and_only_if_it_may_be_a_date(spark):
    df = spark.createDataFrame(ROWS, COLS).repartition(2)
    plan = infer.state_of(df)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("gettimestamp(") == len(df.columns)
    assert plan.count("case when (contains(") + plan.count("case when ((contains(") >= len(df.columns)
    odd = ["1/1/2020", "1:2", "1/2/2020 3:04x", "1 / : 2", " 1/2/2020 3:04", "1/2/2020 3:04"]
    state = _state(infer.state_of(spark.createDataFrame([(t,) for t in odd], "t string")))["t"]
    assert (state["not_timestamp_ntz"], state["bad_timestamp_ntz"]) == (5, " 1/2/2020 3:04")

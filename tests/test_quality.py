from reelstar.operators import quality as Q


def test_checks_count_failures(spark):
    child = spark.createDataFrame([(1, 0), (1, 1), (2, 2), (None, 1), (5, None), (5, 3)],
                                  "k bigint, flag int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k bigint")
    checks = [Q.Check("c", "k", Q.NOT_NULL), Q.Check("c", "k", Q.UNIQUE),
              Q.Check("c", "flag", Q.UNIQUE),
              Q.Check("c", "k", Q.RELATIONSHIPS, to="p", field="k"),
              Q.Check("c", "flag", Q.ACCEPTED_VALUES, values=(0, 1)),
              Q.Check("p", "k", Q.UNIQUE)]
    got = {(r.model, r.column, r.test): r.failures
           for r in Q.run_checks({"c": child, "p": parent}, checks).collect()}
    assert got == {
        ("c", "k", "not_null"): 1,
        ("c", "k", "unique"): 2,            # 1 and 5 repeat; null ignored
        ("c", "flag", "unique"): 1,          # 1 repeats
        ("c", "k", "relationships"): 2,      # two rows with 5; null child ignored
        ("c", "flag", "accepted_values"): 2,  # distinct 2 and 3
        ("p", "k", "unique"): 1,
    }


def test_checks_of_an_empty_model_and_of_texts(spark):
    empty = spark.createDataFrame([], "k string")
    texts = spark.createDataFrame([("a",), ("A",), ("",), ("",), (None,)], "k string")
    checks = [Q.Check("e", "k", t, to="t", field="k", values=("a",)) for t in Q.KINDS]
    assert {r.test: r.failures for r in Q.run_checks({"e": empty, "t": texts}, checks).collect()} == dict.fromkeys(Q.KINDS, 0)
    checks = [Q.Check("t", "k", t, to="e", field="k", values=("a",)) for t in Q.KINDS]
    got = {r.test: r.failures for r in Q.run_checks({"e": empty, "t": texts}, checks).collect()}
    assert got == {"not_null": 1, "unique": 1, "relationships": 4, "accepted_values": 2}


def test_null_checks_shuffle_no_value(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS k")
    plan = Q.run_checks({"m": df}, [Q.Check("m", "k", Q.NOT_NULL)])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    plan = Q.run_checks({"m": df}, [Q.Check("m", "k", Q.UNIQUE)])._jdf.queryExecution().executedPlan().toString()
    exchanged = plan.split("hashpartitioning", 1)[1].split(")", 1)[0]
    assert "_h#" in exchanged and "_v#" not in exchanged


def test_declared_suite_shape():
    suite = Q.DECLARED_SUITE
    assert len(suite) == 53
    kinds = {k: len(Q.checks_of_kind(k)) for k in Q.KINDS}
    assert kinds == {"not_null": 25, "unique": 20, "relationships": 7, "accepted_values": 1}

"""Insert-ignore into a bucketed table: rows, replays, nulls and the plan."""

import random
import uuid

from reelstar.plans import catalog
from reelstar.sources import bucketed as B

ORDER = ["v"]
SCHEMA = "a string, b int, v int"


def _table(spark, tmp_path, rows, buckets=4):
    name = f"t_{uuid.uuid4().hex}"
    B.create(spark.createDataFrame(rows, SCHEMA), name, ["a", "b"], buckets, str(tmp_path / name), ORDER)
    return name


def _rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=str)


def test_each_key_once_and_replays_add_nothing(spark, tmp_path):
    name = _table(spark, tmp_path, [("x", 1, 5), ("x", 1, 4), (None, 2, 1)])
    assert _rows(spark, name) == sorted([("x", 1, 4), (None, 2, 1)], key=str)
    batch = spark.createDataFrame([("x", 1, 0), (None, 2, 0), ("x", None, 9), ("x", None, 8), ("y", 1, 1), ("y", 1, 1)], SCHEMA)
    want = sorted([("x", 1, 4), (None, 2, 1), ("x", None, 8), ("y", 1, 1)], key=str)
    for _ in range(2):
        B.insert_ignore(batch, name, ORDER)
        assert _rows(spark, name) == want
    B.insert_ignore(batch.limit(0), name, ORDER)
    assert _rows(spark, name) == want
    assert B.buckets_of(spark, name) == (4, ["a", "b"])


def test_empty_target(spark, tmp_path):
    name = _table(spark, tmp_path, [])
    B.insert_ignore(spark.createDataFrame([("x", 1, 1)], SCHEMA), name, ORDER)
    assert _rows(spark, name) == [("x", 1, 1)]


def test_hot_key_and_brute_force(spark, tmp_path):
    rows = [("hot", 0, v % 7) for v in range(500)] + [(f"k{v % 90}", v % 3, v) for v in range(400)]
    name = _table(spark, tmp_path, rows[::5])
    B.insert_ignore(spark.createDataFrame(rows, SCHEMA), name, ORDER)
    want = {}
    for part in (rows[::5], rows):
        firsts = {}
        for a, b, v in part:
            firsts[a, b] = min(v, firsts.get((a, b), v))
        want = firsts | want
    assert _rows(spark, name) == sorted(((a, b, v) for (a, b), v in want.items()), key=str)


def test_target_is_not_exchanged(spark, tmp_path):
    name = _table(spark, tmp_path, [(f"k{k}", k, k) for k in range(200)], 16)
    batch = spark.range(1000).selectExpr("CONCAT('k', id) AS a", "CAST(id AS INT) AS b", "CAST(id AS INT) AS v")
    plan = B.new_rows(batch, name, ORDER)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):].splitlines()
    scan = next(k for k, line in enumerate(join) if "FileScan parquet" in line)
    side = next(k for k in range(scan, 0, -1) if "+- Sort" in join[k])   # the target's side of the first join
    assert "Bucketed: true" in join[scan] and "LeftAnti" in join[0]
    assert not any("Exchange" in line for line in join[side:scan])
    assert "hashpartitioning(a" in "".join(join[:side]) and ", 16)" in "".join(join[:side])


def test_batch_is_exchanged_once_and_not_written(spark, tmp_path):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table(spark, tmp_path, [(f"k{k}", k, k) for k in range(200)], n)
    batch = spark.range(1000).selectExpr("CONCAT('k', id) AS a", "CAST(id AS INT) AS b", "CAST(id AS INT) AS v")
    new = B.new_rows(batch, name, ORDER)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert plan.index("SortMergeJoin") < plan.index("SortAggregate") < plan.index("Exchange")   # reduced before it meets the table
    assert sorted(r.b for r in new.collect()) == list(range(200, 1000))


def test_nulls_in_batch_or_table_or_both(spark, tmp_path):
    rng = random.Random(11)

    def some(nulls):
        return [(rng.choice("pqr" + "-" * nulls).replace("-", "") or None, rng.choice([1, 2, 3] + [None] * nulls), rng.randint(0, 9)) for _ in range(40)]

    for in_table, in_batch in ((0, 1), (1, 0), (1, 1)):
        rows, batch = some(in_table)[:6], some(in_batch)
        name = _table(spark, tmp_path, rows, 8)
        B.insert_ignore(spark.createDataFrame(batch, SCHEMA), name, ORDER)
        want = {}
        for part in (rows, batch):
            firsts = {}
            for a, b, v in part:
                firsts[a, b] = min(v, firsts.get((a, b), v))
            want = firsts | want
        assert _rows(spark, name) == sorted(((a, b, v) for (a, b), v in want.items()), key=str)


def _purchases(spark, folder):
    """The tables that the purchase feed reads: three orders of two lines, one line given twice."""
    for name, rows, schema in (
            ("nation", [(1, "X")], "n_nationkey int, n_name string"),
            ("customer", [(1, 1)], "c_custkey long, c_nationkey int"),
            ("part", [(1, "p", 2.5), (2, "q", 1.0)], "p_partkey long, p_name string, p_retailprice double"),
            ("orders", [(k, 1, "2024-01-02") for k in (1, 2, 3)], "o_orderkey long, o_custkey long, o_orderdate string"),
            ("lineitem", [(k, part, part, 5.0) for k in (1, 2, 3) for part in (1, 2)] + [(1, 1, 3, 4.0)],
             "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_the_loads_read_one_staged_table(spark, tmp_path, monkeypatch):
    plans = []
    for name in ("create", "insert_ignore"):
        def keep(rows, *a, of=getattr(B, name), **b):
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
            return of(rows, *a, **b)
        monkeypatch.setattr(B, name, keep)
    rows = catalog.insert_ignore_bucketed(spark, _purchases(spark, tmp_path)).collect()
    assert sorted((r.invoice_number, r.stock_code, r.quantity) for r in rows) == [
        ("1", "1", 4), ("1", "2", 5), ("2", "1", 5), ("2", "2", 5), ("3", "1", 5), ("3", "2", 5)]
    assert len(plans) == 3 and not any("Join" in p for p in plans)

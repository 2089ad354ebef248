"""Loads that keep rejected rows: every row has one outcome, its reason, file and text."""

from reelstar.schemas import RAW_PURCHASE
from reelstar.sources import quarantine as R

HEAD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
GOOD = '1,A,"two, words",3,12/1/2010 8:26,2.5,17850.0,UK'
ROWS = {"price": "2,B,x,3,12/1/2010 8:26,n/a,17850.0,UK", "quantity": "3,C,x,many,12/1/2010 8:26,2.5,,UK",
        "customer": "4,D,x,3,unknown,2.5,,UK", "date": "5,E,x,3,31/31/2010 8:26,2.5,1,UK", "no date": "6,F,x,3,,2.5,1,UK",
        "short": "7,G,x,3"}


def _load(spark, tmp_path, *files):
    (tmp_path / "in").mkdir()
    for k, rows in enumerate(files):
        (tmp_path / "in" / f"{k}.csv").write_text(HEAD + "".join(r + "\n" for r in rows))
    out = str(tmp_path / "out")
    R.load(spark, str(tmp_path / "in"), RAW_PURCHASE, out, *R.purchase_rules())
    return out


def test_every_row_has_one_outcome(spark, tmp_path):
    out = _load(spark, tmp_path, [GOOD, *ROWS.values()], [GOOD, ROWS["price"]])
    kept = R.kept(spark, RAW_PURCHASE, out)
    assert kept.schema.names == RAW_PURCHASE.names
    assert sorted((r.InvoiceNo, r.Description, r.UnitPrice) for r in kept.collect()) == [
        ("1", "two, words", 2.5), ("1", "two, words", 2.5), ("6", "x", 2.5)]
    back = {(r.InvoiceNo, r.reason, r.source_file.rsplit("/", 1)[1]): r.text for r in R.rejected(spark, RAW_PURCHASE, out).collect()}
    assert {k: v for k, v in back.items() if k[1] == R.MALFORMED} == {
        ("2", R.MALFORMED, "0.csv"): ROWS["price"], ("2", R.MALFORMED, "1.csv"): ROWS["price"],
        ("3", R.MALFORMED, "0.csv"): ROWS["quantity"], ("7", R.MALFORMED, "0.csv"): ROWS["short"]}
    assert [k for k in back if k[1] != R.MALFORMED] == [("5", "bad invoice date", "0.csv")]
    assert "31/31/2010" in back["5", "bad invoice date", "0.csv"]
    counts = {(r.outcome, r.reason): r.n_rows for r in R.outcomes(spark, RAW_PURCHASE, out).collect()}
    assert counts == {("kept", ""): 3, ("rejected", R.MALFORMED): 4, ("rejected", "bad invoice date"): 1,
                      ("dropped", "missing customer"): 1, ("read", ""): 9}


def test_good_rows_are_read_without_the_others(spark, tmp_path):
    out = _load(spark, tmp_path, [GOOD, ROWS["price"]])
    plan = R.kept(spark, RAW_PURCHASE, out)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan


def test_a_file_with_a_header_only(spark, tmp_path):
    out = _load(spark, tmp_path, [])
    assert {(r.outcome, r.n_rows) for r in R.outcomes(spark, RAW_PURCHASE, out).collect()} == {("read", 0)}

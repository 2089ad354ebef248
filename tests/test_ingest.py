import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.schemas import RAW_LOG, RAW_REVIEW
from reelstar.sources.files import list_files, read_csv
from reelstar.sources.ledger import read_ledger
from reelstar.sources.sinks import export_csv
from reelstar.streaming.ingest import InjectedFailure, ingest_stream, ingest_with_ledger

REVIEWS = 'cid,review_str,id_review\n1,"He said ""great""\nand left",10\n2,plain,11\n'


def _write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def _identity(df):
    return df


def test_quoted_multiline_review_is_one_row(spark, tmp_path):
    _write(tmp_path, "r.csv", REVIEWS)
    rows = read_csv(spark, str(tmp_path / "r.csv"), RAW_REVIEW, multiline=True).collect()
    assert len(rows) == 2 and rows[0].review_str == 'He said "great"\nand left'


def test_listing_reads_no_content(spark, tmp_path):
    _write(tmp_path / "in", "a.csv", "x\n")
    _write(tmp_path / "in" / "sub", "b.csv", "y\n")
    _write(tmp_path / "in", "c.txt", "z\n")
    names = sorted(r.path.rsplit("/", 1)[1] for r in list_files(spark, str(tmp_path / "in"), "*.csv").collect())
    assert names == ["a.csv", "b.csv"]


def test_ledger_ingest_once_and_survives_crash(spark, tmp_path):
    src, sink, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    _write(src, "a.csv", "id_review,logs\n1,<log><os>iOS</os></log>\n2,<log/>\n")
    assert ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink) == 1
    assert ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink) == 0
    _write(src, "b.csv", "id_review,logs\n3,<log/>\n")
    try:
        ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink, fail_before_mark=True)
        raise AssertionError("expected the injected failure")
    except InjectedFailure:
        pass
    assert read_ledger(spark, ledger).count() == 1
    assert ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink) == 1
    out = spark.read.parquet(sink)
    assert sorted(r.id_review for r in out.collect()) == [1, 2, 3]   # no loss, no duplicate
    assert read_ledger(spark, ledger).count() == 2


def test_stream_available_now_picks_only_new_files(spark, tmp_path):
    src, sink, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src, "a.csv", REVIEWS)
    flag = lambda df: df.withColumn("n", F.length("review_str"))
    assert ingest_stream(spark, str(src), RAW_REVIEW, flag, sink, ckpt, multiline=True) == 1
    assert ingest_stream(spark, str(src), RAW_REVIEW, flag, sink, ckpt, multiline=True) == 0
    _write(src, "b.csv", "cid,review_str,id_review\n3,more,12\n")
    assert ingest_stream(spark, str(src), RAW_REVIEW, flag, sink, ckpt, multiline=True) == 1
    assert sorted(r.id_review for r in spark.read.parquet(sink).collect()) == [10, 11, 12]


def test_ledger_crash_then_new_file_before_the_retry(spark, tmp_path):
    src, sink, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    _write(src, "a.csv", "id_review,logs\n1,<log/>\n")
    with pytest.raises(InjectedFailure):
        ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink, fail_before_mark=True)
    _write(src, "b.csv", "id_review,logs\n2,<log/>\n")
    assert ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink) == 2
    assert sorted(r.id_review for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_ledger_runs_every_batch_and_odd_file_names(spark, tmp_path):
    src, sink, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    names = ["a[1].csv", "a1.csv", "b{x,y}.csv", "c d.csv", "e%20f.csv"]
    for i, name in enumerate(names):
        _write(src, name, f"id_review,logs\n{i},<log/>\n")
    assert ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink, batch_files=2) == len(names)
    assert sorted(r.id_review for r in spark.read.parquet(sink).collect()) == list(range(len(names)))
    assert ingest_with_ledger(spark, str(src), ledger, RAW_LOG, _identity, sink) == 0


def test_two_sinks_of_one_source_by_default_checkpoint(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "a.csv", REVIEWS)
    for sink in ("one", "two"):
        out = str(tmp_path / sink)
        assert ingest_stream(spark, str(src), RAW_REVIEW, _identity, out, multiline=True) == 1
        assert ingest_stream(spark, str(src), RAW_REVIEW, _identity, out, multiline=True) == 0
        assert spark.read.parquet(out).count() == 2


def test_ledger_other_errors_are_raised(spark, tmp_path):
    (tmp_path / "ledger").mkdir()
    (tmp_path / "ledger" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_ledger(spark, str(tmp_path / "ledger")).count()


def test_malformed_field_is_kept_in_the_corrupt_column(spark, tmp_path):
    _write(tmp_path, "r.csv", "id_review,logs\n1,<log/>\nabc,<log/>\n")
    rows = read_csv(spark, str(tmp_path / "r.csv"), RAW_LOG, corrupt_col="_bad").collect()
    assert [(r.id_review, r._bad) for r in rows] == [(1, None), (None, "abc,<log/>")]


def test_stream_replays_a_batch_that_was_written_but_not_committed(spark, tmp_path):
    from pyspark.errors import StreamingQueryException
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("id_review", T.LongType()), T.StructField("logs", T.StringType())])
    rows = spark.range(200).select(F.col("id").alias("id_review"), F.concat(F.lit("<os>"), "id", F.lit("</os>")).alias("logs"))
    export_csv(rows.where("id_review < 150").repartition(6), src, "append")

    def run(**kw):
        return ingest_stream(spark, src, schema, lambda df: df, out, max_files_per_trigger=2, **kw)

    with pytest.raises(StreamingQueryException, match="InjectedFailure"):
        run(fail_before_commit=True)
    assert 0 < spark.read.parquet(out).count() < 150        # one batch is there, uncommitted
    assert run() == 3
    export_csv(rows.where("id_review >= 150").coalesce(1), src, "append", rows_per_file=20)     # late: files of 20, 20, 10 rows
    assert run() == 2 and run() == 0
    assert sorted(r.id_review for r in spark.read.parquet(out).collect()) == list(range(200))

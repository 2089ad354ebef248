"""Incremental ingest of new files only.

Two forms with the same guarantee -- every file lands exactly once, even if
the job dies between writing data and recording the file:

* ``ingest_with_ledger``: the new files (listing minus ledger and manifest)
  are dealt to batches, and the manifest (path, batch) is stored before any
  data is written.  Then every batch that the ledger does not hold yet is
  read, transformed, written into the folder named after it (overwrite) and
  marked.  A run that died leaves its batches in the manifest; the next run
  finishes them into their own folders, whatever files came in meanwhile.
* ``ingest_stream``: Structured Streaming file source with
  ``trigger(availableNow=True)``; the source's own log in the checkpoint
  folder remembers processed files, and ``foreachBatch`` writes each
  micro-batch into a folder named by stream and batch id (overwrite), so a
  replayed batch replaces its own output.

The batch folders are Hive-style (``batch=<name>``), so reading the sink
folder adds that column: the load each row came from.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.sources import ledger as L
from reelstar.sources.files import list_files, read_csv

Transform = Callable[[DataFrame], DataFrame]

BATCH_FILES = 1000   # files of a batch on average: bounds the names held by the driver


class InjectedFailure(RuntimeError):
    """Raised by the tests' crash switch between the data write and the ledger."""


def _literal_path(path: str) -> str:
    """A listed path as a reader argument: glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _plan_batches(spark: SparkSession, listing: DataFrame, ledger_path: str, manifest_path: str,
                  batch_files: int) -> None:
    """Store (path, batch) for the files that neither manifest nor ledger holds."""
    new = L.new_files(L.new_files(listing, L.read_ledger(spark, ledger_path)),
                      L.read_manifest(spark, manifest_path)).select("path").distinct()
    files = new.count()
    if files:
        buckets = -(-files // batch_files)
        name = F.concat(F.lit(f"{uuid.uuid4().hex[:16]}-"),
                        F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("string"))
        new.select("path", name.alias("batch")).write.mode("append").parquet(manifest_path)


def ingest_with_ledger(spark: SparkSession, source_dir: str, ledger_path: str,
                       schema: T.StructType, transform: Transform, sink_path: str,
                       glob: str = "*.csv", multiline: bool = False,
                       batch_files: int = BATCH_FILES, fail_before_mark: bool = False) -> int:
    """Process all files under ``source_dir`` that the ledger does not hold.

    Returns the number of files processed.  Batches hold about ``batch_files``
    files and are run until none is left; only one batch's file *names* reach
    the driver at a time (to build the reader), rows stay on the executors.
    The manifest lies beside the ledger (``<ledger>.manifest``).
    """
    manifest_path = f"{ledger_path.rstrip('/')}.manifest"
    _plan_batches(spark, list_files(spark, source_dir, glob), ledger_path, manifest_path, batch_files)
    done = 0
    while True:
        manifest = L.read_manifest(spark, manifest_path)
        waiting = L.new_files(manifest, L.read_ledger(spark, ledger_path)).select("batch").first()
        if waiting is None:
            return done
        batch = manifest.where(F.col("batch") == waiting.batch).select("path").distinct()
        paths = [_literal_path(r.path) for r in batch.collect()]
        data = transform(read_csv(spark, paths, schema, multiline=multiline))
        data.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch={waiting.batch}")
        if fail_before_mark:
            raise InjectedFailure("stopped after the data write, before the ledger commit")
        L.mark_processed(spark, ledger_path, batch)
        done += len(paths)


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                  transform: Transform, sink_path: str, checkpoint: str | None = None,
                  glob: str = "*.csv", multiline: bool = False,
                  max_files_per_trigger: int | None = None, fail_before_commit: bool = False) -> int:
    """Run the file stream until every file present now is processed.

    Returns the number of micro-batches that ran.  A micro-batch whose data
    was written but not committed (``fail_before_commit`` stops there) is
    replayed by the next run into the same folder.  The checkpoint defaults to
    a hidden folder in the sink, one per source: it lives as long as the data
    it describes, and two sinks of one source do not share it.
    """
    sink = sink_path.rstrip("/")
    if checkpoint is None:
        checkpoint = f"{sink}/_stream-{hashlib.sha1(source_dir.encode()).hexdigest()[:12]}"
    tag = hashlib.sha1(f"{source_dir}\n{checkpoint}".encode()).hexdigest()[:12]
    reader = (spark.readStream.schema(schema)
              .option("header", True).option("escape", '"')
              .option("multiLine", multiline)
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir)
    batches: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        out.write.mode("overwrite").parquet(f"{sink}/batch={tag}-{batch_id}")
        if fail_before_commit:
            raise InjectedFailure("stopped after the data write, before the stream's commit")
        batches.append(batch_id)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)

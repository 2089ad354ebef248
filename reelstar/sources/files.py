"""File sources: CSV with a declared or inferred schema, file listings and
the Parquet tables of a data folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_TEXT = "\u0000"   # stands for a missing field inside the reader, where "" is a text


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
             multiline: bool = False, with_source: bool = False, corrupt_col: str | None = None,
             keep_empty: bool = False) -> DataFrame:
    """CSV with a header row and a declared schema (no inference pass).

    ``multiline`` handles quoted fields that contain newlines (review texts);
    it makes each file one split, so keep it off for line-oriented feeds,
    whose large files then split by ``spark.sql.files.maxPartitionBytes``.
    ``with_source`` keeps the file of each row (``_metadata.file_path``).
    ``corrupt_col`` adds that column with the whole text of each row that has
    a malformed field (null otherwise); without it such a field is just null.
    ``keep_empty`` tells a quoted empty text ("") from a missing one.
    """
    if corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    reader = (spark.read.schema(schema)
              .option("header", True)
              .option("escape", '"')
              .option("multiLine", multiline)
              .option("mode", "PERMISSIVE"))
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    if keep_empty:
        reader = reader.option("nullValue", NO_TEXT).option("emptyValue", "")
    if multiline:
        reader = reader.option("lineSep", "\n")
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def read_csv_inferred(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with header and inferred schema (costs one extra pass over the data)."""
    return spark.read.csv(list(paths) if not isinstance(paths, str) else paths,
                          header=True, inferSchema=True)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Listing under ``root``: (path, length, modified).

    The binary-file source lists in parallel and, because ``content`` is not
    selected, never opens the files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"))


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder (``{data_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")

"""Column types of delimited text, with the evidence for them, in one pass.

The state is a row per column: how many values there are and, for each kind of
type, how many values refuse it and the smallest of these.  States of several
loads merge by sums and minima, so a feed's types are kept up without a second
look at earlier files.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.functions import parse_invoice_ts
from reelstar.schemas import INVOICE_DATE_FORMAT
from reelstar.sources.files import read_csv


def _like_invoice_ts(c: str) -> Column:
    """Whether a text holds the literals of the date format: one that lacks them cannot
    parse, and a parse that fails costs an exception a value."""
    return reduce(Column.__and__, [F.col(c).contains(x) for x in sorted(set(re.sub("[A-Za-z]", "", INVOICE_DATE_FORMAT)))])


# kind -> test of a text, narrowest first; numbers are plain ASCII, integers of 18 digits at most
KINDS = {
    "bigint": lambda c: F.col(c).rlike(r"\A[+-]?[0-9]{1,18}\z"),
    "double": lambda c: F.col(c).rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"),
    "timestamp_ntz": lambda c: F.when(_like_invoice_ts(c), parse_invoice_ts(c).isNotNull()),
    "boolean": lambda c: F.lower(c).isin("true", "false"),
}
TEXT = "string"


def header_schema(spark: SparkSession, paths: str | Sequence[str]) -> T.StructType:
    """Text columns named by the header of the files."""
    return spark.read.option("header", True).option("escape", '"').csv(paths if isinstance(paths, str) else list(paths)).schema


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def state_of(rows: DataFrame) -> DataFrame:
    """``column_name, n_rows, n_null`` and per kind ``not_<kind>`` (values that refuse it) and ``bad_<kind>`` (the smallest of them).

    ``rows`` has text columns.  One aggregation without a key: each task reduces
    its rows to one, whatever the values.  An empty text is a value, and no
    kind takes it.  An empty table gives zeros, no columns no rows.
    """
    def refused(name: str, kind: str) -> Column:
        c = _quoted(name)
        return F.col(c).isNotNull() & ~F.coalesce(KINDS[kind](c), F.lit(False))

    def state(i: int, name: str) -> Column:
        parts = [F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(f"v{i}").isNull()).alias("n_null")]
        for kind in KINDS:
            no = F.col(f"{kind}{i}")
            parts += [F.count_if(no).alias(f"not_{kind}"), F.min(F.when(no, F.col(f"v{i}"))).alias(f"bad_{kind}")]
        return F.struct(*parts)

    if not rows.columns:
        return rows.sparkSession.createDataFrame([], _state_schema())
    # each test once a value: count and minimum both read its result
    tested = rows.select(*(F.col(_quoted(c)).alias(f"v{i}") for i, c in enumerate(rows.columns)),
                         *(refused(c, k).alias(f"{k}{i}") for i, c in enumerate(rows.columns) for k in KINDS))
    return tested.agg(F.array(*(state(i, c) for i, c in enumerate(rows.columns))).alias("s")).select(F.inline("s"))


def _state_schema() -> str:
    return "column_name string, n_rows long, n_null long, " + ", ".join(f"not_{k} long, bad_{k} string" for k in KINDS)


def read_state(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """State of CSV files with a header row."""
    return state_of(read_csv(spark, paths, header_schema(spark, paths), multiline=multiline, keep_empty=True))


def merge(*states: DataFrame) -> DataFrame:
    """The state of all the loads together; a column that a load lacks has fewer rows."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy("column_name").agg(*(
        (F.min(c) if c.startswith("bad_") else F.sum(c)).alias(c) for c in both.columns if c != "column_name"))


def with_types(state: DataFrame) -> DataFrame:
    """The state with ``column_type``: the first kind that no value refuses, text if there is none or no value."""
    kind = F.when(F.col("n_rows") == F.col("n_null"), TEXT)
    for k in KINDS:
        kind = kind.when(F.col(f"not_{k}") == 0, k)
    return state.withColumn("column_type", kind.otherwise(TEXT))


def inferred_schema(state: DataFrame, names: Sequence[str]) -> T.StructType:
    """Declared schema for ``read_csv`` in the order of ``names``: one row per column comes to the driver.

    The CSV reader has its own timestamp format, so such a column is read as text.
    """
    types = dict(with_types(state).select("column_name", "column_type").collect())
    return T.StructType([T.StructField(n, T.StringType() if types.get(n, TEXT) in (TEXT, "timestamp_ntz")
                                       else T._parse_datatype_string(types[n])) for n in names])

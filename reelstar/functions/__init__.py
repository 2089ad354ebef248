"""Scalar column functions (Column -> Column), all built-in expressions so
that they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelstar.schemas import INVOICE_DATE_FORMAT

# Fixed value: token the public surrogate-key macro substitutes for null parts.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

# Season by month number (month ranges are inclusive).
SEASONS = (("Spring", 3, 5), ("Summer", 6, 8), ("Fall", 9, 11))
SEASON_OTHER = "Winter"

# Default text forms tried, in order, when a log date arrives as text.
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "MM-dd-yyyy")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def xml_tag(c: str | Column, tag: str) -> Column:
    """Text of the first ``<tag>...</tag>`` on one line; '' when absent, null for null."""
    return F.regexp_extract(_col(c), f"<{tag}>(.*?)</{tag}>", 1)


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex of the '-'-joined text of the columns, nulls replaced by a token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts) if len(parts) > 1 else parts[0])


def season(date_col: str | Column) -> Column:
    """Season of a date; a null date falls to the else branch (Winter)."""
    month = F.month(_col(date_col))
    expr = None
    for name, lo, hi in SEASONS:
        cond = month.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(SEASON_OTHER)


def parse_date(c: str | Column, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """First format that parses wins; text that parses with none is null."""
    return F.coalesce(*[F.try_to_date(_col(c), f) for f in formats])


def parse_invoice_ts(c: str | Column, fmt: str = INVOICE_DATE_FORMAT) -> Column:
    """Wall-clock timestamp from text, null when malformed (coercing parse).

    The text is read as UTC and its seconds since 1970 are added to a
    zone-less epoch, so no daylight-saving gap of the session's zone shifts it.
    """
    utc = F.try_to_timestamp(F.concat(_col(c), F.lit(" +0000")), F.lit(f"{fmt} Z"))
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.unix_seconds(utc))


def array_to_text(c: str | Column, sep: str = ",") -> Column:
    """Annotation array -> one string; null or empty array gives ''."""
    return F.concat_ws(sep, _col(c))


def sentiment_flag(text: str | Column, negative: str = "negative") -> Column:
    """0 only for the exact negative label, 1 for anything else (null included)."""
    return F.when(_col(text) == negative, F.lit(0)).otherwise(F.lit(1)).cast("int")


def amount(quantity: str | Column, unit_price: str | Column) -> Column:
    """Exact line amount: bigint x decimal(8,3) -> decimal(29,3)."""
    return _col(quantity) * _col(unit_price)


def all_not_null(cols: Iterable[str]) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond if cond is not None else F.lit(True)


def money(c: str | Column) -> Column:
    """Final money values leave the engine as double; sums stay exact before."""
    return _col(c).cast("double")

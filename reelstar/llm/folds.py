"""Folds and bounded samples of rows by stable hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; a null id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def smallest(rows: DataFrame, h: Column, most: int) -> DataFrame:
    """Distinct rows, those of the ``most`` smallest hashes; only hashes are sorted."""
    rows = rows.distinct()
    last = rows.select(h.alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return rows.where(h <= last) if last is not None else rows


def sampled(rows: DataFrame, keys: list[Column], most: int, seed: int) -> DataFrame:
    """At most ``most`` rows (all, if there are no more), by a hash of ``keys``, which tell rows apart.

    Where rows repeat whole, each counts once, and fewer than ``most`` may be left.
    """
    n = rows.count()
    if n <= most:
        return rows
    h = F.xxhash64(F.lit(seed), *keys)
    return smallest(rows.where(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * most / n)), h, most)

"""Quality rules as a ledger of failure bits and measurements.

Every rule is evaluated once per document; its failure is one bit of
``fail_bits`` and its measurements stay beside it.  A policy is a version with
a bit mask: a document is kept if no bit of the mask is set, so policies are
applied, compared and ablated over the stored ledger without reading a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm import textscan as T

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")
SCHEMA = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3:0xF5] = True  # lead bytes count once per character

# rule name -> SQL condition under which the document fails; the position is the bit
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "few_letters": "100 * n_letters < 50 * word_chars",
    "shouting": "100 * n_upper > 50 * n_letters",
}


@dataclass(frozen=True)
class Policy:
    """A named version of a rule selection."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("v1", tuple(RULES))


def _line_duplicates(buf: np.ndarray, offs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: lines with a word, and those equal to an earlier one."""
    n = len(offs) - 1
    lo, hi = int(offs[0]), int(offs[-1])
    breaks = np.flatnonzero(buf[lo:hi] == 10) + lo
    doc = np.concatenate([np.arange(n), np.searchsorted(offs, breaks, side="right") - 1])
    begin = np.concatenate([offs[:-1], breaks + 1])
    order = np.lexsort((begin, doc))
    begin, row = begin[order], doc[order]
    end = np.empty_like(begin)
    end[:-1] = begin[1:] - 1
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    end[last] = offs[row[last] + 1]
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, row = begin[worded], end[worded], row[worded]
    keys = np.zeros(len(begin), np.uint64)
    for a in range(0, len(begin), 1 << 16):
        b = min(a + (1 << 16), len(begin))
        at, to = int(begin[a]), int(end[b - 1])
        keys[a:b] = T.hash_ranges(buf[at:to], at, begin[a:b], end[a:b])
    _, copies = _repeats(keys, row, first_too=False)
    return np.bincount(row, minlength=n), np.bincount(row[copies], minlength=n)


def _repeats(keys: np.ndarray, row: np.ndarray, first_too: bool) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, key), and the flags of entries that are repeats in their row."""
    order = np.lexsort((keys, row))
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        same[1:] = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    if first_too and len(keys) > 1:
        same[:-1] |= same[1:]
    flags = np.zeros(len(keys), bool)
    flags[order] = same
    return order, flags


def _measure(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    n = len(offs) - 1
    start, end, h, ptr = T.scan_words(buf, offs)
    n_words = np.diff(ptr)
    lo, hi = int(offs[0]), int(offs[-1])
    part = buf[lo:hi]

    def total(flags: np.ndarray) -> np.ndarray:
        return T.count_by_row(flags, offs - lo)

    row = np.repeat(np.arange(n), n_words)
    flags = np.zeros(len(h), bool)
    if len(h) > 2:
        inside = np.flatnonzero(row[2:] == row[:-2])
        key = T.mix(h[inside] + T.mix(h[inside + 1] + T.mix(h[inside + 2])))
        _, repeated = _repeats(key, row[inside], first_too=True)
        for k in range(3):
            flags[inside[repeated] + k] = True
    lines, dup = _line_duplicates(buf, offs, start)
    return [n_words, total((part & 0xC0 != 0x80) & ~T.WS[part]), total(_SYMBOL[part]), dup,
            T.count_by_row(flags, ptr), lines, total(_LETTER[part]), total(_UPPER[part])]


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: the measurements and ``fail_bits``.

    A null or empty text measures 0 everywhere and fails ``few_words``; rows
    repeat as they repeat in ``docs``; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(1))
            for i, j in T.row_blocks(offs, 4 << 20):
                cols = _measure(buf, offs[i:j + 1])
                yield pa.record_batch([batch.column(0).slice(i, j - i), *(pa.array(c.astype(np.int64)) for c in cols)],
                                      names=["doc_id", *MEASURES])

    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)) for i, cond in enumerate(RULES.values())]
    fail = bits[0]
    for b in bits[1:]:
        fail = fail.bitwiseOR(b)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, SCHEMA).withColumn("fail_bits", fail.cast("int")))


def apply_policy(rows: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """``column`` is true where no rule of the policy failed."""
    return rows.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents failing it, and those only it removes.

    Documents are first counted per distinct ``fail_bits`` (map-side), so at
    most 2**rules counts are exploded whatever the number of documents.
    """
    names = list(RULES)
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit")) for r in policy.rules))
    counts = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    return (counts.select(hit.alias("hit"), "n", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("hit").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("hit") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_here")))

"""Packing of tokenised documents into sequences of a fixed capacity.

Exact-complement hashing over a length histogram: the longest waiting length
opens a sequence; the index of single, pair and triple length sums (bit sets
over lengths) tells which waiting lengths fill its gap exactly; if none does,
the longest that fits goes in and the smaller gap is tried again.  A
combination is consumed as often as the counts of its lengths allow, so the
plan depends on the histogram alone: at most ``capacity`` counts reach the
driver, and at most one length class per step is used up.

Scale: pieces are numbered within (partition, length) while they are made;
prefix sums over the per-partition counts turn that into a rank per length,
and the broadcast plan (bounded by the capacity, not by the data) maps (length,
rank) to (sequence, offset).  No group of equal lengths meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm import textscan as T
from reelstar.llm.word_bpe import word_bpe
from reelstar.session import cut_lineage

END_ID = 1
BLOCK_BYTES = 2 << 20   # of text whose words a worker holds at once
PIECE_SCHEMA = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, part int, local_rank long"


@dataclass(frozen=True)
class Run:
    """``copies`` sequences that all hold the same lengths: (length, uses) pairs."""
    copies: int
    items: tuple[tuple[int, int], ...]


def _without(bits: int, rev: int, length: int, capacity: int) -> tuple[int, int]:
    return bits & ~(1 << length), rev & ~(1 << (capacity - length))


def _exact(gap: int, bits: int, rev: int, capacity: int, left) -> list[int] | None:
    """One, two or three waiting lengths that sum to ``gap``; the longest first."""
    if bits >> gap & 1:
        return [gap]

    def pair(total: int, third: int) -> list[int] | None:
        both = bits & (rev >> (capacity - total)) & ((1 << total) - 1)
        while both:
            b = both.bit_length() - 1
            c = total - b
            need = {b: 0, c: 0, third: 0}
            for x in (b, c, third):
                need[x] += 1
            if all(left(x) >= n for x, n in need.items() if x):
                return [b, c]
            both &= ~(1 << b)
            both &= ~(1 << c)
        return None

    if got := pair(gap, 0):
        return got
    rest = bits & ((1 << gap) - 1)
    while rest:
        d = rest.bit_length() - 1
        if 3 * d < gap:  # the longest of three is a third at least
            return None
        if got := pair(gap - d, d):
            return [d, *got]
        rest &= ~(1 << d)
    return None


def plan_runs(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Runs of equal sequences that hold every counted length once."""
    count = {int(k): int(v) for k, v in histogram.items() if v > 0}
    if any(not 0 < k <= capacity for k in count):
        raise ValueError("lengths must lie between 1 and the capacity")
    all_bits = sum(1 << k for k in count)
    all_rev = sum(1 << (capacity - k) for k in count)
    runs = []
    while all_bits:
        first = all_bits.bit_length() - 1
        used = {first: 1}
        bits, rev, gap = all_bits, all_rev, capacity - first

        def left(x: int) -> int:
            return count.get(x, 0) - used.get(x, 0)

        if not left(first):
            bits, rev = _without(bits, rev, first, capacity)
        while gap and bits:
            take = _exact(gap, bits, rev, capacity, left)
            if take is None:
                below = bits & ((1 << (gap + 1)) - 1)
                if not below:
                    break
                take = [below.bit_length() - 1]
            for x in take:
                used[x] = used.get(x, 0) + 1
                gap -= x
                if not left(x):
                    bits, rev = _without(bits, rev, x, capacity)
        copies = min(count[x] // n for x, n in used.items())
        for x, n in used.items():
            count[x] -= copies * n
            if not count[x]:
                all_bits, all_rev = _without(all_bits, all_rev, x, capacity)
        runs.append(Run(copies, tuple(sorted(used.items(), reverse=True))))
    return runs


def placements(runs: list[Run]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, uses, offset) by rank."""
    at: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for run in runs:
        offset = 0
        for length, uses in run.items:
            lo = at.get(length, 0)
            rows.setdefault(length, []).append((lo, sequence, uses, offset))
            at[length] = lo + run.copies * uses
            offset += length * uses
        sequence += run.copies
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def _block_ids(bpe, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a block in a row, and the documents' offsets."""
    start, end, h, ptr = T.scan_words(buf, offs)
    if not len(h):
        return np.zeros(0, "<u4"), np.zeros(len(offs), np.int64)
    _, first, code = T.groups(h)
    ids = bpe.chunks(T.joined(buf, start[first], end[first]).split(b" ")[:-1])
    size = np.fromiter((len(x) for x in ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    n = size[code]
    stop = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=stop[1:])
    at = np.repeat((np.cumsum(size) - size)[code] - stop[:-1], n)
    at += np.arange(len(at))
    return flat[at], stop[ptr]


def _ids_by_block(bpe, buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``BLOCK_BYTES`` of text (one row at least), each with its ids and offsets."""
    for i, j in T.row_blocks(offs, BLOCK_BYTES):
        yield i, j, *_block_ids(bpe, buf, offs[i:j + 1])


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document.

    A document is the ids of its text (null: empty) and then id 1, so every
    row, repeated ones too, gives one piece at least.  ``ids`` holds the
    piece's ids (little-endian unsigned 32 bit) if ``keep_ids``, else null.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocabulary.value)
        part = TaskContext.get().partitionId()
        rank = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(1))
            keys = batch.column(0)
            for i, j, flat, ptr in _ids_by_block(bpe, buf, offs):
                rows, piece, start, length, crc, out, local = [], [], [], [], [], [], []
                for k in range(j - i):
                    ids = flat[ptr[k]:ptr[k + 1]].tobytes() + END_ID.to_bytes(4, "little")
                    for p, a in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[a:a + 4 * capacity]
                        n = len(cut) // 4
                        rows.append(i + k)
                        piece.append(p)
                        start.append(a // 4)
                        length.append(n)
                        crc.append(zlib.crc32(cut))
                        out.append(cut if keep_ids else None)
                        local.append(int(rank[n]))
                        rank[n] += 1
                yield pa.record_batch([
                    keys.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array(out, pa.binary()),
                    pa.array([part] * len(rows), pa.int32()), pa.array(local, pa.int64()),
                ], names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, PIECE_SCHEMA))


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and offset of each.

    Columns: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.
    Sequences are gapless from offset 0 and hold ``capacity`` ids at most; an
    empty table gives an empty result; a null doc_id stays null.
    """
    pieces = cut_lineage(token_pieces(docs, vocabulary_path, capacity, keep_ids))
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(placements(plan_runs(histogram, capacity)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    base = per_part.select("length", "part", before.alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                n = int(length[rows[0]])
                runs = plan.value[n]
                run = runs[np.searchsorted(runs[:, 0], rank[rows], side="right") - 1]
                sequence[rows] = run[:, 1] + (rank[rows] - run[:, 0]) // run[:, 2]
                offset[rows] = run[:, 3] + (rank[rows] - run[:, 0]) % run[:, 2] * n
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    keep = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
    return (pieces.join(base, ["length", "part"])
            .select(*keep, (F.col("before") + F.col("local_rank")).alias("rank"))
            .mapInArrow(place, "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, "
                               "sequence_id long, offset long"))

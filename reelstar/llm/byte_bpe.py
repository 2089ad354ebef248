"""Byte-level BPE by a global shuffle of distinct words.

Texts are split once.  A block of documents (a few MB of text) sends one row
with its positions, an array of word numbers, and one row per slice of the
words' hash space with its distinct words of that slice.  The slices are
shuffled; within a slice equal words of all blocks meet and each is encoded
once; the ids return to their block, where they are laid out by position.  The
positions travel with the slices, so nothing is split or stored twice.  A word
occurs once per block at most, so the most frequent word is no hot key, and a
block is bounded by its bytes (one document at least).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm import textscan as T

BLOCK_BYTES = 16 << 20
WINDOW = 1 << 20   # characters split at a time
SLICES = (256, 1 << 14)   # fewest and most slices of the words' hash space; a task holds one slice's distinct words
TOKENS = 1 << 18   # of one text decoded or digested at a time
ROWS = "block long, slice int, words binary, codes binary, doc_ids array<long>, ptr array<long>"
_ARROW = pa.schema([("block", pa.int64()), ("slice", pa.int32()), ("words", pa.binary()), ("codes", pa.binary()),
                    ("doc_ids", pa.list_(pa.int64())), ("ptr", pa.list_(pa.int64()))])


def _ranks(ranks_text: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_text.splitlines())}


@lru_cache(maxsize=2)
def _core(ranks_text: bytes) -> object:
    return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=_ranks(ranks_text), special_tokens={})._core_bpe


@lru_cache(maxsize=2)
def _token_bytes(ranks_text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, offsets by id."""
    ranks = _ranks(ranks_text)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return np.frombuffer(b"".join(table), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in table])])


def _gather(data: np.ndarray, offs: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``codes`` of ``data`` in a row, and the offset of each."""
    size = np.diff(offs)[codes]
    stop = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(int(stop[-1])) + np.repeat(offs[codes] - stop[:-1], size)
    return data[at], stop


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _windows(text: str) -> Iterator[str]:
    """Parts of about ``WINDOW`` characters of a long text, cut between a letter or
    digit and white space, where every pre-token ends; a text without such a
    place is one part."""
    at = 0
    while len(text) - at > WINDOW:
        cut = next((i for i in range(at + WINDOW, len(text)) if text[i].isspace() and text[i - 1].isalnum()), len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, all lowest bytes first: small numbers leave little once compressed."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _pack(sizes: np.ndarray, data: bytes) -> bytes:
    """Sizes of parts and their bytes (or numbers' planes), compressed."""
    return zstandard.compress(len(sizes).to_bytes(4, "little") + _planes(sizes) + data, 3)


def _unpack(packed: bytes) -> tuple[np.ndarray, bytes]:
    data = zstandard.decompress(packed)
    n = int.from_bytes(data[:4], "little")
    return _from_planes(data[4:4 + 4 * n]), data[4 + 4 * n:]


def _slice_of(block: int, slices: int) -> int:
    """The slice with which a block's positions travel."""
    return zlib.crc32(block.to_bytes(8, "little")) % slices


def _blocks(batches: Iterator[pa.RecordBatch], pattern, slices: int):
    """Per block: id, document ids, packed positions, document offsets, and the distinct words of each slice.

    Words are numbered by slice, then by frequency; positions hold frequency
    ranks and the number of each rank (rising among words of one frequency).
    """
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        _, offs = T.text_buffer(batch.column(1))
        for i, j in T.row_blocks(offs, BLOCK_BYTES):
            number: dict[str, int] = {}
            codes, ptr = [], [0]
            for text in batch.column(1).slice(i, j - i):
                found = 0
                for window in _windows(text.as_py() or ""):
                    codes.append(np.array([number.setdefault(w, len(number)) for w in pattern.findall(window)], np.uint32))
                    found += len(codes[-1])
                ptr.append(ptr[-1] + found)
            words = [w.encode() for w in number]
            at = np.array([zlib.crc32(w) % slices for w in words], np.int64)
            order = np.argsort(at, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            flat = np.concatenate(codes)
            count = np.bincount(flat, minlength=len(words))
            by_count = np.lexsort((place, -count))
            rank = np.empty(len(order), np.uint32)
            rank[by_count] = np.arange(len(order), dtype=np.uint32)
            cuts = np.searchsorted(at[order], np.arange(slices + 1)).tolist()
            sliced = [(k, [words[w] for w in order[a:b].tolist()]) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            # steps between the numbers of neighbouring ranks, folded so that small ones of both signs are small
            step = np.diff(place[by_count], prepend=0)
            packed = _pack(np.where(step < 0, -2 * step - 1, 2 * step), _planes(rank[flat]))
            yield (part << 32) + seq, batch.column(0).slice(i, j - i), packed, ptr, sliced
            seq += 1


def _positions(packed: bytes) -> np.ndarray:
    """The word numbers of a block's tokens."""
    step, ranks = _unpack(packed)
    return np.cumsum(np.where(step % 2, -(step + 1) // 2, step // 2))[_from_planes(ranks)]


def _slices(docs: DataFrame) -> int:
    """As many slices as shuffle partitions, within bounds."""
    least, most = SLICES
    return min(max(least, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), most)


def encode(docs: DataFrame, ranks_path: str, pattern: str, slices: int | None = None) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of every row of ``docs``.

    A null or empty text has no ids; repeated rows and ids stay repeated; a
    null doc_id stays null; special tokens are ordinary text; other columns are
    not read.  ``slices`` is the number of parts of the words' hash space.
    """
    sc = docs.sparkSession.sparkContext
    slices = slices or _slices(docs)
    with open(ranks_path, "rb") as f:
        ranks = sc.broadcast(f.read())

    def split(batches):
        rx = regex.compile(pattern)
        for block, ids, packed, ptr, sliced in _blocks(batches, rx, slices):
            yield pa.record_batch([pa.array([block]), pa.array([_slice_of(block, slices)], pa.int32()), pa.array([None], pa.binary()),
                                   pa.array([packed], pa.binary()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                                   pa.array([ptr], pa.list_(pa.int64()))], schema=_ARROW)
            for a in range(0, len(sliced), 64):
                some = sliced[a:a + 64]
                none = pa.nulls(len(some))
                yield pa.record_batch([pa.array([block] * len(some), pa.int64()), pa.array([k for k, _ in some], pa.int32()),
                                       pa.array([_pack(np.array([len(w) for w in ws]), b"".join(ws)) for _, ws in some], pa.binary()), none.cast(pa.binary()),
                                       none.cast(_ARROW.field(4).type), none.cast(_ARROW.field(5).type)], schema=_ARROW)

    def encoded(batches):
        core = _core(ranks.value)
        before, known = None, {}
        for batch in batches:
            out = []
            for k, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if k != before:
                    before, known = k, {}
                if packed is None:
                    out.append(None)
                    continue
                sizes, data = _unpack(packed)
                stop = np.cumsum(sizes).tolist()
                ids, counts = [], []
                for a, b in zip([0, *stop], stop):
                    w = data[a:b]
                    got = known.get(w)
                    if got is None:
                        got = known[w] = array("I", core.encode_single_piece(w))
                    ids.append(got)
                    counts.append(len(got))
                out.append(_pack(np.array(counts), _planes(np.frombuffer(b"".join(ids), "u4"))))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.binary()), *batch.columns[3:]], schema=_ARROW)

    def assemble(rows: pa.Table) -> pa.Table:
        own = rows.filter(rows.column("codes").is_valid())
        back = rows.filter(rows.column("words").is_valid()).sort_by("slice")
        parts = [_unpack(packed.as_py()) for packed in back.column("words")]
        flat = np.concatenate([np.zeros(0, "<u4"), *(_from_planes(ids).astype("<u4") for _, ids in parts)])
        stop = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(sizes for sizes, _ in parts)]))]).astype(np.int64)
        ids, stop = _gather(flat, stop, _positions(own.column("codes")[0].as_py()))
        ptr = stop[own.column("ptr")[0].values.to_numpy()]
        ends = pa.array((ptr * 4).astype(np.int64)).buffers()[1]
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ptr) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(ids))])
        return pa.table([own.column("doc_ids")[0].values, held.cast(pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = rows.mapInArrow(split, ROWS).repartition("slice").sortWithinPartitions("slice").mapInArrow(encoded, ROWS)
    return met.groupBy("block").applyInArrow(assemble, "doc_id long, ids binary")


def _decoded(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> Iterator[bytes]:
    for a in range(0, len(ids), TOKENS):
        yield _gather(*table, ids[a:a + TOKENS].astype(np.int64))[0].tobytes()


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded`` (bytes): the token-byte table joined to the ids.

    The table is the vocabulary (bounded by its file), so it is broadcast and
    every task joins it by position; ids outside it raise an IndexError.
    """
    with open(ranks_path, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())
    names = encoded.columns

    def run(batches):
        table = _token_bytes(ranks.value)
        for batch in batches:
            out = [b"".join(_decoded(np.frombuffer(ids.as_py() or b"", "<u4"), table)) for ids in batch.column("ids")]
            yield pa.record_batch([*batch.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    return encoded.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in encoded.dtypes) + ", decoded binary")


def digests(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded rows.

    Ids are decoded as ``decode`` does, in the same pass, a bounded part of a
    text at a time; the texts are not stored.
    """
    with open(ranks_path, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        table = _token_bytes(ranks.value)
        for batch in batches:
            out = []
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_py() or b"", "<u4")
                listed, text = hashlib.sha256(), hashlib.sha256()
                for a in range(0, len(ids), TOKENS):
                    listed.update(("," if a else "").encode() + ",".join(map(str, ids[a:a + TOKENS].tolist())).encode())
                for part in _decoded(ids, table):
                    text.update(part)
                out.append((len(ids), listed.hexdigest(), text.hexdigest()))
            n, sums, texts = zip(*out) if out else ((), (), ())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Language-model scores from a probabilistic suffix tree over byte classes.

A text is its words (A-Z lower-cased), a space after each, and an end mark.
Symbols are byte classes (one per letter and per UTF-8 continuation byte,
digits, groups of other bytes); a byte's probability is its class's times its
share in the class.  Context counts of every training text
are summed by Spark for contexts of 0 to ``DEPTH`` symbols.  A counted context
is retained if its next-symbol distribution diverges from its parent's by
``GAIN`` nats in all, or if a longer retained context needs it.  Distributions
are smoothed with the parent's.  Every byte is scored by the longest retained
suffix of its past.

A gram is a number whose leading digits are its latest past symbols, so a
context's grams are neighbours.  The grams are dealt to slices by the context of
``TOP + 1`` symbols.  A block of documents sends one row per slice, the sorted
numbers compressed; a slice merges what all blocks counted and is the part of the
tree below its contexts, one row.  Scoring sends each block's distinct grams to
their slices, where they are looked up level by level, and sends the
probabilities back.  Only the contexts of up to ``TOP`` symbols (SYMBOLS**TOP at
most, whatever the corpus) are dense arrays.  Word counts travel in the same way.

Texts are coded ``PIECE`` bytes at a time, so a text of any length costs memory
for its words, not for every symbol; a block has ``BLOCK_BYTES``, or one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm import textscan as T
from reelstar.llm.folds import fold
from reelstar.session import cut_lineage

DEPTH = 6
TOP = 2
SLICES = 256             # at least; as many as shuffle partitions
GAIN = 8.0
MU = 4.0
BLOCK_BYTES = 12 << 20
PIECE = 1 << 20
START, END = 0, 1
CLASS = np.zeros(256, np.int64)
CLASS[:128] = 2                                  # other ASCII
CLASS[32] = 3
CLASS[48:58] = 4
for _k, _c in enumerate(b".,-'!?"):
    CLASS[_c] = 5 + _k
CLASS[97:123] = np.arange(11, 37)
CLASS[128:192] = 37 + np.arange(64)
CLASS[192:256] = 101
CLASS[195] = 102
SYMBOLS = 103
_SHIFT = SYMBOLS ** np.arange(DEPTH + 2, dtype=np.int64)


def _spaced(buf: np.ndarray, start: np.ndarray, end: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, lower-cased, with one space after each; and the texts' offsets."""
    out = T.LOWER[np.frombuffer(T.joined(buf, start, end), np.uint8)]
    return out, np.concatenate([[0], np.cumsum(end - start + 1)]).astype(np.int64)[ptr]


def symbols(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class sequence (each text after DEPTH start marks, then the end mark), its rows' first and last places."""
    n = np.diff(offs)
    extra = DEPTH + 1
    first = np.concatenate([[0], np.cumsum(n + extra)])
    out = np.zeros(int(first[-1]), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[np.arange(int(n.sum())) + row * extra + DEPTH] = CLASS[buf[int(offs[0]):int(offs[-1])]]
    out[first[1:] - 1] = END
    return out, first[:-1] + DEPTH, first[1:]


def grams(seq: np.ndarray) -> np.ndarray:
    """Codes of DEPTH past symbols, the latest as the highest digit, and the next one as the lowest."""
    code = seq[DEPTH:].copy() if len(seq) > DEPTH else np.zeros(0, np.int64)
    for k in range(1, DEPTH + 1):
        code += seq[DEPTH - k:len(seq) - k] * _SHIFT[DEPTH + 1 - k] if len(code) else 0
    return code


def _coded(buf: np.ndarray, start: np.ndarray, end: np.ndarray, ptr: np.ndarray) -> Iterator[tuple]:
    """(codes, their rows, plain bytes, their rows) of the texts' words, a piece at a time; the end marks are coded too."""
    sums = np.concatenate([[0], np.cumsum(end - start + 1)])
    size = sums[ptr]
    i, n = 0, len(ptr) - 1
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(size, size[i] + PIECE, side="right")) - 1), n, i + PIECE // 8)
        if size[j] - size[i] <= 2 * PIECE:
            text, at = _spaced(buf, start[ptr[i]:ptr[j]], end[ptr[i]:ptr[j]], ptr[i:j + 1] - ptr[i])
            seq, first, last = symbols(text, at)
            code = grams(seq)
            step = np.zeros(len(code) + 1, np.int64)
            np.add.at(step, first - DEPTH, 1)
            np.add.at(step, last - DEPTH, -1)
            rows = np.arange(i, j)
            yield code[np.cumsum(step[:-1]) > 0], np.repeat(rows, np.diff(at) + 1), text, np.repeat(rows, np.diff(at))
        else:
            a, past = int(ptr[i]), np.full(DEPTH, START)
            while a < ptr[j]:
                b = min(max(a + 1, int(np.searchsorted(sums, sums[a] + PIECE, side="right")) - 1), int(ptr[j]))
                text = T.LOWER[np.frombuffer(T.joined(buf, start[a:b], end[a:b]), np.uint8)]
                seq = np.concatenate([past, CLASS[text], np.full(int(b == ptr[j]), END)])
                yield grams(seq), np.full(len(seq) - DEPTH, i), text, np.full(len(text), i)
                a, past = b, seq[len(seq) - DEPTH:]
        i = j


def _distinct(buf: np.ndarray, start: np.ndarray, end: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes of the texts, and their counts."""
    parts = [np.unique(code, return_counts=True) for code, *_ in _coded(buf, start, end, ptr)]
    return _merged([k for k, _ in parts], [n for _, n in parts])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted arrays, and the sums of their counts."""
    key, n = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(key, kind="stable")   # merges the sorted runs
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _pack(numbers: np.ndarray, sorted_ones: bool = False) -> bytes:
    """64-bit numbers by byte planes (their steps, if sorted), compressed."""
    x = np.diff(numbers, prepend=numbers.dtype.type(0)) if sorted_ones else numbers
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def _unpack(packed: bytes, sorted_ones: bool = False, kind=np.int64) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    x = np.ascontiguousarray(flat.T).view(kind).ravel()
    return np.cumsum(x) if sorted_ones else x


def _top_index(code: np.ndarray) -> np.ndarray:
    """Place of the latest TOP symbols (oldest first) and the next one in the dense arrays."""
    out, up = code % SYMBOLS, 1
    for k in range(1, TOP + 1):
        up *= SYMBOLS
        out = out + code // _SHIFT[DEPTH + 1 - k] % SYMBOLS * up
    return out


def _slice_of(code: np.ndarray, slices: int) -> np.ndarray:
    return (T.mix((code // _SHIFT[DEPTH - TOP]).astype(np.uint64)) % np.uint64(slices)).astype(np.int64)


def _by_slice(key: np.ndarray, at: np.ndarray, slices: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Order by slice (sorted keys stay sorted in it), and each used slice with the places of its keys."""
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(slices + 1))
    return order, [(k, order[cuts[k]:cuts[k + 1]]) for k in np.unique(at).tolist()]


@dataclass(frozen=True)
class PlainTree:
    """A whole tree in one process."""

    child: np.ndarray      # (node, symbol) -> node, or -1
    log_p: np.ndarray      # (node, symbol) -> log10 probability
    byte_log_p: np.ndarray  # log10 share of a byte in its class


@dataclass(frozen=True)
class Tree:
    """Gram counts as a distributed table, a row per slice (slice, codes, n: packed), and what is bounded by the alphabet."""

    counts: DataFrame
    slices: int
    byte_counts: dict[int, int]
    prob: np.ndarray        # (TOP past symbols, next) -> smoothed probability
    best: np.ndarray        # the same -> log10 probability at the longest retained suffix

    @property
    def byte_log_p(self) -> np.ndarray:
        """log10 share of a byte in its class."""
        return _byte_log_p(self.byte_counts)

    @cached_property
    def plain(self) -> PlainTree:
        """The whole tree on the driver, for looking at small ones; scoring does not use it."""
        count: list[dict[int, dict[int, int]]] = [{0: {}}, *({} for _ in range(DEPTH))]
        for _, codes, counts in self.counts.collect():
            for code, n in zip(_unpack(codes, True).tolist(), _unpack(counts).tolist()):
                nxt, ctx = code % SYMBOLS, 0
                for d in range(DEPTH + 1):
                    if d:       # contexts are numbered with the oldest symbol as the highest digit
                        ctx += code // int(_SHIFT[DEPTH + 1 - d]) % SYMBOLS * int(_SHIFT[d - 1])
                    row = count[d].setdefault(ctx, {})
                    row[nxt] = row.get(nxt, 0) + n
        return build([(d, ctx, list(row.items())) for d, level in enumerate(count) for ctx, row in level.items()], self.byte_counts)

    @property
    def child(self) -> np.ndarray:
        return self.plain.child

    @property
    def log_p(self) -> np.ndarray:
        return self.plain.log_p


def _byte_log_p(byte_counts: dict[int, int]) -> np.ndarray:
    bytes_n = np.array([byte_counts.get(b, 0) + 1.0 for b in range(256)])
    return np.log10(bytes_n / np.bincount(CLASS, bytes_n, SYMBOLS)[CLASS])


def _flat() -> np.ndarray:
    flat = np.full(SYMBOLS, 1 / (SYMBOLS - 1))
    flat[START] = 0
    return flat


def _log(prob: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.maximum(np.log10(prob), -30)


def _gain(n: np.ndarray, own: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Nats by which smoothed dense distributions of ``n`` symbols diverge from their parents'."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return n * np.nan_to_num(np.where(own > 0, own * np.log(own / up), 0)).sum(axis=-1)


def _top_probs(count: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Smoothed distributions of the contexts of 0 to TOP symbols (oldest symbol first), and whether each diverges."""
    count = count.reshape((SYMBOLS,) * (TOP + 1)).astype(float)
    probs, passed = [], []
    for d in range(TOP + 1):
        c = count.sum(axis=tuple(range(TOP - d)))
        n = c.sum(axis=-1)
        if not d:
            probs.append((c + _flat()) / (n + 1))
            passed.append(np.array(True))
            continue
        probs.append((c + MU * probs[-1]) / (n[..., None] + MU))
        passed.append(_gain(n, probs[-1], probs[-2]) >= GAIN)
    return probs, passed


def _top_best(probs: list[np.ndarray], passed: list[np.ndarray], needed: np.ndarray) -> np.ndarray:
    """log10 probabilities at the longest retained suffix of TOP symbols; ``needed`` by longer contexts."""
    keep = [*passed[:-1], passed[-1] | needed.reshape(passed[-1].shape)]
    for d in range(TOP, 0, -1):
        keep[d - 1] = keep[d - 1] | keep[d].any(axis=0)
    best = probs[0]
    for d in range(1, TOP + 1):
        best = np.where(keep[d][..., None], probs[d], best)
    return _log(best).ravel()


class Subtrees:
    """The tree below the contexts of TOP symbols, for the sorted codes of one slice."""

    def __init__(self, code: np.ndarray, n: np.ndarray, prob: np.ndarray):
        self.prob, self.ctx, self.total, self.keep, self.key, self.count = prob, {}, {}, {}, {}, {}
        nxt, n, up, inner = code % SYMBOLS, n.astype(float), None, {}
        for d in range(TOP + 1, DEPTH + 1):
            prefix = code // _SHIFT[DEPTH + 1 - d]
            new = np.concatenate([[True], prefix[1:] != prefix[:-1]]) if len(code) else np.zeros(0, bool)
            row = np.cumsum(new) - 1
            self.ctx[d] = prefix[new]
            self.key[d], at, back = np.unique(row * SYMBOLS + nxt, return_index=True, return_inverse=True)
            self.count[d] = np.bincount(back, n, len(at))
            own_row = self.key[d] // SYMBOLS
            size = len(self.ctx[d])
            self.total[d] = np.bincount(own_row, self.count[d], size)
            above = prob[_top_index(code[at])] if d == TOP + 1 else up[at]
            own = (self.count[d] + MU * above) / (self.total[d][own_row] + MU)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.bincount(own_row, own * np.log(own / above), size)
            # a symbol that never follows has MU / (total + MU) of its parent's probability
            gain = gain + (1 - np.bincount(own_row, own, size)) * np.log(MU / (self.total[d] + MU))
            self.keep[d] = self.total[d] * gain >= GAIN
            up, inner[d] = own[back], row
        for d in range(DEPTH, TOP + 1, -1):     # a retained context retains its own suffixes
            self.keep[d - 1][np.unique(inner[d - 1][self.keep[d][inner[d]]])] = True

    def needed(self) -> np.ndarray:
        """Contexts of TOP symbols (oldest first) that have a longer retained one."""
        latest = self.ctx[TOP + 1][self.keep[TOP + 1]] // SYMBOLS
        return np.unique(sum(latest // SYMBOLS ** (TOP - k) % SYMBOLS * SYMBOLS ** (k - 1) for k in range(1, TOP + 1)))

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """log10 probability at the longest retained context; NaN if it has TOP symbols or fewer."""
        p, best, nxt = self.prob[_top_index(code)], np.full(len(code), np.nan), code % SYMBOLS
        for d in range(TOP + 1, DEPTH + 1):
            if not len(self.ctx[d]):
                break
            prefix = code // _SHIFT[DEPTH + 1 - d]
            row = np.minimum(np.searchsorted(self.ctx[d], prefix), len(self.ctx[d]) - 1)
            there = self.ctx[d][row] == prefix
            key = row * SYMBOLS + nxt
            at = np.minimum(np.searchsorted(self.key[d], key), len(self.key[d]) - 1)
            n = np.where(self.key[d][at] == key, self.count[d][at], 0)
            p = np.where(there, (n + MU * p) / (self.total[d][row] + MU), p)
            best = np.where(there & self.keep[d][row], p, best)
        return _log(best)


def _slim(docs: DataFrame, folds: int, held: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       (fold(F.col("doc_id"), folds) == held).alias("held_out"))


def fit(docs: DataFrame, folds: int = 7, held: int = 2) -> Tree:
    """Tree of the texts outside fold ``held``; without any, every symbol is equally likely."""
    slices = max(SLICES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(0))
            for i, j in T.row_blocks(offs, BLOCK_BYTES):
                start, end, _, ptr = T.scan_words(buf, offs[i:j + 1])
                key, n = _distinct(buf, start, end, ptr)
                _, parts = _by_slice(key, _slice_of(key, slices), slices)
                seen = np.bincount(T.LOWER[buf[int(offs[i]):int(offs[j])]], minlength=256)
                seen[T.WS] = 0
                seen[32] = len(start)      # the space after each word
                rows = [(k, _pack(key[at], True), _pack(n[at])) for k, at in parts] + [(-1, b"", _pack(seen))]
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))],
                                      names=["slice", "codes", "n"])

    def merged(t: pa.Table) -> pa.Table:
        k = t.column("slice")[0].as_py()
        if k < 0:       # byte counts
            return pa.table([pa.array([k], pa.int32()), pa.array([b""], pa.binary()),
                             pa.array([_pack(sum(_unpack(x.as_py()) for x in t.column("n")))], pa.binary())], names=["slice", "codes", "n"])
        key, n = _merged([_unpack(x.as_py(), True) for x in t.column("codes")], [_unpack(x.as_py()) for x in t.column("n")])
        return pa.table([pa.array([k], pa.int32()), pa.array([_pack(key, True)], pa.binary()), pa.array([_pack(n)], pa.binary())],
                        names=["slice", "codes", "n"])

    rows = _slim(docs, folds, held).where("not held_out").select("text")
    tree = cut_lineage(rows.mapInArrow(counted, "slice int, codes binary, n binary").groupBy("slice")
                       .applyInArrow(merged, "slice int, codes binary, n binary"))
    byte_row = tree.where("slice < 0").first()
    counts = tree.where("slice >= 0")

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(int(_SHIFT[TOP + 1]))
        for batch in batches:
            for codes, n in zip(batch.column("codes"), batch.column("n")):
                np.add.at(total, _top_index(_unpack(codes.as_py(), True)), _unpack(n.as_py()))
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen].astype(np.int64))], names=["code", "n"])

    count = np.zeros(int(_SHIFT[TOP + 1]), np.int64)  # bounded by the alphabet, as the rows that fill it
    got = counts.mapInArrow(top, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    count[got.column("code").to_numpy()] = got.column("n").to_numpy()
    probs, passed = _top_probs(count)
    prob = np.ascontiguousarray(probs[TOP]).ravel()
    shared = docs.sparkSession.sparkContext.broadcast(prob)

    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, n in zip(batch.column("codes"), batch.column("n")):
                yield pa.record_batch([pa.array(Subtrees(_unpack(codes.as_py(), True), _unpack(n.as_py()), shared.value).needed())], names=["ctx"])

    needed = np.zeros(int(_SHIFT[TOP]), bool)
    for r in counts.mapInArrow(longer, "ctx long").distinct().collect():
        needed[r["ctx"]] = True
    seen = _unpack(bytes(byte_row["n"])) if byte_row else np.zeros(256, np.int64)
    return Tree(counts, slices, {b: int(c) for b, c in enumerate(seen) if c}, prob, _top_best(probs, passed, needed))


def build(contexts: list[tuple[int, int, list[tuple[int, int]]]], byte_counts: dict[int, int]) -> PlainTree:
    """Divergence pruning, smoothing and the child table."""
    level: list[dict[int, int]] = [{} for _ in range(DEPTH + 1)]
    for d, ctx, _ in contexts:
        level[d][ctx] = len(level[d])
    count = [np.zeros((max(len(m), 1), SYMBOLS)) for m in level]
    for d, ctx, nexts in contexts:
        for s, n in nexts:
            count[d][level[d][ctx], s] = n
    prob = [(count[0] + _flat()) / (count[0].sum(axis=1, keepdims=True) + 1)]
    parents, keep = [None], [np.ones(1, bool)]
    for d in range(1, DEPTH + 1):
        ctx = np.array(list(level[d]), np.int64)
        up = np.array([level[d - 1][c] for c in (ctx % _SHIFT[d - 1]).tolist()], np.int64)
        if not len(ctx):
            prob.append(np.zeros((0, SYMBOLS)))
            parents.append(up)
            keep.append(np.zeros(0, bool))
            continue
        n = count[d].sum(axis=1, keepdims=True)
        own = (count[d] + MU * prob[d - 1][up]) / (n + MU)
        prob.append(own)
        parents.append(up)
        keep.append(_gain(n[:, 0], own, prob[d - 1][up]) >= GAIN)
    for d in range(DEPTH, 1, -1):
        keep[d - 1][parents[d][keep[d]]] = True
    number = [np.full(len(k), -1, np.int64) for k in keep]
    at = 0
    for d, k in enumerate(keep):
        number[d][k] = at + np.arange(int(k.sum()))
        at += int(k.sum())
    child = np.full((at, SYMBOLS), -1, np.int32)
    log_p = np.zeros((at, SYMBOLS), np.float32)
    for d, k in enumerate(keep):
        log_p[number[d][k]] = _log(prob[d][:len(k)][k])
        if d:
            ctx = np.array(list(level[d]), np.int64)
            child[number[d - 1][parents[d][k]], (ctx // _SHIFT[d - 1])[k]] = number[d][k]
    return PlainTree(child, log_p, _byte_log_p(byte_counts))


def score(docs: DataFrame, tree: Tree, folds: int = 7, held: int = 2) -> DataFrame:
    """Every row's ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A null text reads as empty (its only token is the end); a null doc_id is in
    fold 0 and stays null; repeated rows repeat; other columns are not read.
    Each block of documents sends its distinct grams and word hashes to their
    slices, so a frequent one is asked for once per block, and the answers
    return to the block.
    """
    best = docs.sparkSession.sparkContext.broadcast((tree.prob, tree.best, tree.byte_log_p))
    slices = tree.slices    # grams have slices 0 to slices - 1, words the following ones
    answer_schema = "block long, slice int, x binary, n long, v long"

    def blocks(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(1))
            for i, j in T.row_blocks(offs, BLOCK_BYTES):
                yield (part << 32) + seq, batch.slice(i, j - i), buf, offs[i:j + 1]
                seq += 1

    def keys(buf, offs):
        """Words, their distinct hashes and each word's number, the hashes' places by slice."""
        start, end, h, ptr = T.scan_words(buf, offs, lower=True)
        uniq, _, code = T.groups(np.append(h, np.uint64(0)))      # the end mark is the word of hash 0
        return start, end, ptr, uniq, code, _by_slice(uniq, (uniq >> np.uint64(40)).astype(np.int64) % slices, slices)[1]

    def asked(batches):
        for block, rows, buf, offs in blocks(batches):
            start, end, ptr, uniq, code, word_parts = keys(buf, offs)
            gram = _distinct(buf, start, end, ptr)[0]
            gram_parts = _by_slice(gram, _slice_of(gram, slices), slices)[1]
            learn = ~rows.column(2).to_numpy(zero_copy_only=False)
            n = np.bincount(code[:-1], np.repeat(learn, np.diff(ptr)), len(uniq)).astype(np.int64)
            n[0] += int(learn.sum())                               # hash 0 is the smallest
            out = [(k, _pack(gram[at], True), None) for k, at in gram_parts]
            out += [(slices + k, _pack(uniq[at], True), _pack(n[at])) for k, at in word_parts]
            yield pa.record_batch([pa.array([block] * len(out), pa.int64()), pa.array([r[0] for r in out], pa.int32()),
                                   *(pa.array([r[k] for r in out], pa.binary()) for k in (1, 2))], names=["block", "slice", "codes", "n"])

    def answer(asks: pa.Table, part: pa.Table) -> pa.Table:
        if not asks.num_rows:       # nothing asked below these contexts
            return pa.table({"block": pa.array([], pa.int64()), "slice": pa.array([], pa.int32()), "x": pa.array([], pa.binary()),
                             "n": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        block, at = asks.column("block").to_pylist(), asks.column("slice")[0].as_py()
        n, v = [0] * len(block), [0] * len(block)
        if at < slices:
            tree = [(_unpack(c.as_py(), True), _unpack(m.as_py())) for c, m in zip(part.column("codes"), part.column("n"))]
            below = Subtrees(*(tree[0] if tree else (np.zeros(0, np.int64),) * 2), best.value[0])
            x = [_pack(below.log_p(_unpack(c.as_py(), True)).astype(np.float32)) for c in asks.column("codes")]
        else:
            own = [_unpack(c.as_py(), True, np.uint64) for c in asks.column("codes")]
            all_keys, total = _merged([k.view(np.int64) for k in own], [_unpack(m.as_py()) for m in asks.column("n")])
            x = [_pack(total[np.searchsorted(all_keys, k.view(np.int64))]) for k in own]
            n[0], v[0] = int(total.sum()), int((total > 0).sum())   # said once per slice
        return pa.table([pa.array(block, pa.int64()), pa.array([at] * len(block), pa.int32()), pa.array(x, pa.binary()),
                         pa.array(n, pa.int64()), pa.array(v, pa.int64())], names=["block", "slice", "x", "n", "v"])

    def places(batches):
        for block, rows, buf, offs in blocks(batches):
            yield pa.record_batch(
                [pa.array([block]), pa.array([zstandard.compress(buf[int(offs[0]):int(offs[-1])].tobytes(), 3)], pa.binary()),
                 pa.array([(offs - offs[0]).tolist()], pa.list_(pa.int64())), pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([rows.column(2).to_pylist()], pa.list_(pa.bool_()))],
                names=["block", "texts", "offs", "doc_ids", "held"])

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        buf = np.frombuffer(zstandard.decompress(left.column("texts")[0].as_py()), np.uint8)
        offs = left.column("offs")[0].values.to_numpy()
        told = dict(zip(right.column("slice").to_pylist(), right.column("x").to_pylist()))
        start, end, ptr, uniq, code, word_parts = keys(buf, offs)
        _, shared, byte_log_p = best.value
        n = len(ptr) - 1
        total, pieces = np.zeros(n), []
        for codes, code_row, text, text_row in _coded(buf, start, end, ptr):
            total += np.bincount(text_row, byte_log_p[text], n)
            some, each = np.unique(codes, return_inverse=True)
            first = np.flatnonzero(np.diff(code_row, prepend=-1))    # of each text's symbols
            pieces.append((some, each.astype(np.int32), code_row[first], first))
        gram = _merged([p[0] for p in pieces], [np.zeros(len(p[0]), np.int64) for p in pieces])[0]
        c, log_p = np.zeros(len(uniq)), np.zeros(len(gram))
        for k, at in word_parts:
            c[at] = _unpack(told[slices + k])
        for k, at in _by_slice(gram, _slice_of(gram, slices), slices)[1]:
            log_p[at] = _unpack(told[k], kind=np.float32)
        short = np.isnan(log_p)
        log_p[short] = shared[_top_index(gram[short])]
        logs, known = np.log10(c + 1), c > 0

        def sums(per):
            s = np.concatenate([[0], np.cumsum(per[code[:-1]])])
            return s[ptr[1:]] - s[ptr[:-1]] + per[0]               # and the end mark

        for some, each, rows, first in pieces:      # sorted keys are found many times faster
            total[rows] += np.add.reduceat(log_p[np.searchsorted(gram, some)][each], first)
        return pa.table([left.column("doc_ids")[0].values, left.column("held")[0].values,
                         pa.array(np.diff(ptr) + 1), pa.array(sums(known.astype(np.int64))), pa.array(sums(logs)), pa.array(total)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score"])

    rows = _slim(docs, folds, held)
    asks = rows.mapInArrow(asked, "block long, slice int, codes binary, n binary")
    back = cut_lineage(asks.groupBy("slice").cogroup(tree.counts.groupBy("slice")).applyInArrow(answer, answer_schema))
    whole = back.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    n, v = whole["n"], whole["v"]
    spots = rows.mapInArrow(places, "block long, texts binary, offs array<long>, doc_ids array<long>, held array<boolean>")
    out = spots.groupBy("block").cogroup(back.select("block", "slice", "x").groupBy("block")).applyInArrow(
        assemble, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"), "score")

"""Document quality by a sparse ensemble of rules.

Every text is measured once (``STATISTICS``); the measurements are numbers, so
nothing after the first pass reads a text.  Small trees are boosted on the
measurements of labelled rows, the path to each of their nodes is one
conjunctive rule, and an L1-penalised logistic regression over the rules leaves
weights on few of them.  The result is compiled into one Spark column
expression over the statistics.

Training sees at most ``most`` labelled rows (those of the smallest hashes) on
the driver; measuring and scoring see all.  A text longer than a piece of
``textscan.PIECE`` bytes is measured piece by piece: memory is bounded, and a
line or a word longer than a piece counts once per piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm import textscan as T
from reelstar.llm.folds import fold
from reelstar.session import cut_lineage

ROWS = 4096            # texts of a block
SLOTS = 1 << 16        # of a text's words and lines by hash; more distinct ones are not told apart
STATISTICS = ("chars", "words", "lines", "word_chars", "words_per_line", "upper", "letters", "digits", "symbols", "bars",
              "bangs", "stops", "commas", "spaces", "new_words", "old_lines")
_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "other": range(0xC3, 0xF5), "digits": range(48, 58),
          "symbols": b"#*$%&<>@^~=+_\\/", "bars": b"|", "bangs": b"!?", "stops": b".", "commas": b",;:",
          "breaks": b"\n", "spaces": [0x20, *range(0x09, 0x0E)], "inner": range(0x80, 0xC0)}
_KIND = np.zeros((256, len(_KINDS)))
for _k, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes), _k] = 1


def _pieces(buf: np.ndarray, at: int, end: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``PIECE`` bytes, ended after a line or before white space where there is one."""
    while end - at > T.PIECE:
        part = buf[at:at + T.PIECE]
        breaks = np.flatnonzero(part == 10)
        spaces = breaks if len(breaks) else np.flatnonzero(T.WS[part[1:]])
        cut = at + (int(spaces[-1]) + 1 if len(spaces) else T.PIECE)
        yield at, cut
        at = cut
    yield at, end


def _counts(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: bytes by kind, words, lines with a word; and the used (text, slot) pairs of words and lines."""
    n, lo, hi = len(offs) - 1, int(offs[0]), int(offs[-1])
    row = np.repeat(np.arange(n), np.diff(offs))
    kinds = np.bincount(row * 256 + buf[lo:hi], minlength=n * 256).reshape(n, 256) @ _KIND
    start, _, h, ptr = T.scan_words(buf, offs)
    word_row = np.repeat(np.arange(n), np.diff(ptr))
    words = np.unique(word_row * SLOTS + (h % np.uint64(SLOTS)).astype(np.int64))
    cuts = np.unique(np.concatenate([offs, np.flatnonzero(buf[lo:hi] == 10) + lo + 1]))
    begin, end = cuts[:-1], cuts[1:]
    worded = np.searchsorted(start, end) > np.searchsorted(start, begin)
    begin, end = begin[worded], end[worded]
    line_row = np.searchsorted(offs, begin, side="right") - 1
    end = end - (buf[end - 1] == 10) if len(end) else end
    keys = T.hash_ranges(buf[lo:hi], lo, begin, end) if len(begin) else np.zeros(0, np.uint64)
    lines = np.unique(line_row * SLOTS + (keys % np.uint64(SLOTS)).astype(np.int64))
    return kinds, np.diff(ptr), np.bincount(line_row, minlength=n), words, lines


def measure(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(text, statistic) of one block of texts; an empty text has zeros."""
    n = len(offs) - 1
    if n == 1 and offs[1] - offs[0] > T.PIECE:
        kinds, words, lines, used, seen = 0, 0, 0, np.zeros(SLOTS, bool), np.zeros(SLOTS, bool)
        for a, b in _pieces(buf, int(offs[0]), int(offs[1])):
            k, w, m, word_slots, line_slots = _counts(buf, np.array([a, b]))
            kinds, words, lines = kinds + k, words + w, lines + m
            used[word_slots] = seen[line_slots] = True
        new_words, new_lines = np.array([used.sum()]), np.array([seen.sum()])
    else:
        kinds, words, lines, used, seen = _counts(buf, offs)
        new_words, new_lines = np.bincount(used // SLOTS, minlength=n), np.bincount(seen // SLOTS, minlength=n)
    by = dict(zip(_KINDS, kinds.T))
    chars = np.diff(offs) - by["inner"]
    solid = chars - by["spaces"]
    letters = by["upper"] + by["lower"] + by["other"]

    def share(a, b):
        return a / np.maximum(b, 1)

    return np.column_stack([
        chars, words, lines, share(solid, words), share(words, lines), share(by["upper"], letters), share(letters, solid),
        share(by["digits"], solid), share(by["symbols"], words), share(by["bars"], words), share(by["bangs"], words),
        share(by["stops"], words), share(by["commas"], words), share(by["spaces"], chars), share(new_words, words),
        share(lines - new_lines, lines)])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``STATISTICS`` of every row, as doubles.

    A null or empty text has zeros; repeated rows and ids repeat; a null doc_id
    stays null; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(1))
            for i, j in T.row_blocks(offs, T.PIECE):
                for a in range(i, j, ROWS):
                    b = min(a + ROWS, j)
                    cols = measure(buf, offs[a:b + 1])
                    yield pa.record_batch([batch.column(0).slice(a, b - a), *(pa.array(c) for c in cols.T)],
                                          names=["doc_id", *STATISTICS])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)))


@dataclass(frozen=True)
class Rule:
    """A conjunction: every (statistic, low, high) holds if low < value <= high."""
    bounds: tuple[tuple[str, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for name, low, high in self.bounds:
            v = x[:, STATISTICS.index(name)]
            ok &= (v > low) & (v <= high)
        return ok

    def column(self) -> Column:
        parts = []
        for name, low, high in self.bounds:
            parts += [F.col(name) > F.lit(low)] * (low > -np.inf) + [F.col(name) <= F.lit(high)] * (high < np.inf)
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class Model:
    """Weighted rules; ``bias`` alone where nothing could be learned."""
    rules: tuple[tuple[Rule, float], ...]
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, weight in self.rules:
            z += weight * rule.holds(x)
        return _sigmoid(z)

    def column(self) -> Column:
        """The probability as one expression over the statistics."""
        z = reduce(lambda a, b: a + b, (F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules), F.lit(self.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _edges(v: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` cuts between the values of one statistic, at its quantiles."""
    seen = np.unique(v)
    if len(seen) < 2:
        return np.zeros(0)
    at = np.unique(np.searchsorted(seen, np.quantile(v, np.linspace(0, 1, most + 2)[1:-1])))
    return np.unique((seen[np.minimum(at, len(seen) - 2)] + seen[np.minimum(at, len(seen) - 2) + 1]) / 2)


def _split(codes: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int, least: int) -> tuple[float, int, int]:
    """Gain, statistic and cut of the best split of the rows by gradient ``g`` and curvature ``h``."""
    best = (1e-6, -1, -1)
    whole = g.sum() ** 2 / (h.sum() + 1)
    for f in range(codes.shape[1]):
        gs, hs, ns = (np.cumsum(np.bincount(codes[:, f], w, bins))[:-1] for w in (g, h, None))
        gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
        gain[(ns < least) | (len(g) - ns < least)] = 0
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    return best


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 48, rate: float = 0.3,
               seed: int = 13) -> list[Rule]:
    """The paths to all nodes of ``trees`` boosted trees, each once, in the order found."""
    edges = [_edges(x[:, f], bins - 1) for f in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    rng = np.random.default_rng(seed)
    z, found = np.zeros(len(y)), {}
    least = max(2, len(y) // 2000)

    def grow(rows: np.ndarray, own: dict[int, tuple[float, float]], g, h, level: int, out: np.ndarray) -> None:
        """Splits ``rows``; sets ``out`` for every row that its leaf's bounds hold for."""
        _, f, cut = _split(codes[rows], g[rows], h[rows], bins, least) if level < depth else (0, -1, -1)
        if f < 0:
            inside = np.ones(len(y), bool)
            for s, (low, high) in own.items():
                inside &= (x[:, s] > low) & (x[:, s] <= high)
            out[inside] = g[rows].sum() / (h[rows].sum() + 1)
            return
        at, (low, high) = float(edges[f][cut]), own.get(f, (-np.inf, np.inf))
        left = codes[rows, f] <= cut
        for side, bound in ((left, (low, at)), (~left, (at, high))):
            bounds = own | {f: bound}
            found.setdefault(Rule(tuple((STATISTICS[s], *bounds[s]) for s in sorted(bounds))))
            grow(rows[side], bounds, g, h, level + 1, out)

    for _ in range(trees):
        p = _sigmoid(z)
        chosen = np.sort(rng.permutation(len(y))[:max(1, len(y) // 2)])
        out = np.zeros(len(y))
        grow(chosen, {}, y - p, p * (1 - p), 0, out)
        z += rate * out
    return list(found)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray, steps: int = 150) -> np.ndarray:
    """Weights (bias last, free) of the logistic loss plus ``penalty`` times the L1 norm, by accelerated proximal steps."""
    ext = np.column_stack([r, np.ones(len(r), r.dtype)])
    v = np.ones(ext.shape[1], r.dtype)
    for _ in range(20):      # largest eigenvalue of the curvature's bound
        v = ext.T @ (ext @ v)
        v /= np.sqrt((v * v).sum())
    rate = 1 / (0.26 * float(((ext @ v) ** 2).sum()) / len(r) + 1e-9)
    w, ahead, t = start.copy(), start.copy(), 1.0
    for _ in range(steps):
        new = ahead - rate * (ext.T @ (_sigmoid(ext @ ahead) - y) / len(r))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        if ((ahead - new) * (new - w)).sum() > 0:
            t = 1.0          # restart where the momentum leads uphill
        nxt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / nxt * (new - w), new, nxt
    return w


def _losses(r: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    z = r @ w[:-1] + w[-1]
    return np.logaddexp(0, z) - y * z


def train(x: np.ndarray, y: np.ndarray, seed: int = 13) -> Model:
    """Rules and weights.  The penalty is the largest whose loss on every fifth
    row, kept out for this choice, is within a standard error of the least.

    Rows of one class only give the class's smoothed share, no row gives 0.5.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(np.unique(y)) < 2 or len(y) < 10:
        return Model((), float(np.log(share / (1 - share))))
    order = np.random.default_rng(seed).permutation(len(y))
    x, y = x[order], y[order].astype(float)
    out = np.arange(len(y)) % 5 == 0
    rules = tree_rules(x[~out], y[~out], seed=seed)
    if not rules:
        return Model((), float(np.log(share / (1 - share))))
    r = np.column_stack([rule.holds(x) for rule in rules]).astype(np.float32)
    _, once = np.unique(r, axis=1, return_index=True)     # rules that hold for the same rows
    once = np.sort(once)
    r = r[:, once]
    base = np.append(np.zeros(len(once)), np.log(share / (1 - share)))
    top = np.abs(r[~out].T @ (y[~out] - y[~out].mean())).max() / (~out).sum()
    w, tried = base, []
    for penalty in top * 0.5 ** np.arange(1, 11):
        w = lasso(r[~out], y[~out], penalty, w)
        losses = _losses(r[out], y[out], w)
        tried.append((losses.mean(), losses.std() / np.sqrt(len(losses)), penalty))
    least, error, _ = min(tried)
    penalty = next(p for loss, _, p in tried if loss <= least + error)
    w = lasso(r, y, penalty, base, 600)
    kept = [(rules[k], float(a)) for k, a in zip(once.tolist(), w) if a]
    return Model(tuple(kept), float(w[-1]))


def training_rows(stats: DataFrame, labels: DataFrame, most: int, folds: int = 5, held: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and quality of at most ``most`` labelled rows outside fold ``held``.

    A label row with a null doc_id or a quality other than 0 or 1 is not used;
    of an id's labels the smallest counts.  The ids of the smallest hashes are
    taken, then, where ids repeat in ``stats``, the rows of the smallest hashes.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id"), folds) != held))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    chosen = known.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(most)   # so its broadcast is bounded
    rows = stats.select("doc_id", *STATISTICS).join(F.broadcast(chosen), "doc_id")
    rows = rows.orderBy(F.xxhash64(F.lit(6), "doc_id", *STATISTICS), "doc_id").limit(most).select(*STATISTICS, "quality").toArrow()
    cols = [c.to_numpy() for c in rows.columns]
    order = np.lexsort(cols) if rows.num_rows else np.zeros(0, np.int64)    # the same order in every run
    return np.column_stack([c[order] for c in cols[:-1]]), cols[-1][order].astype(float)


def fit(stats: DataFrame, labels: DataFrame, most: int = 10_000, folds: int = 5, held: int = 0) -> Model:
    """Model of at most ``most`` labelled rows (see ``training_rows``)."""
    return train(*training_rows(stats, labels, most, folds, held))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with ``score``, the model's probability of quality 1, as a column expression.

    Other columns pass through; a column called score is replaced.
    """
    return stats.withColumn("score", model.column())


def assess(docs: DataFrame, labels: DataFrame, most: int = 10_000, folds: int = 5, held: int = 0) -> DataFrame:
    """Statistics and score of every row of ``docs``, learned outside fold ``held``; texts are read once."""
    stats = cut_lineage(statistics(docs))
    return score(stats, fit(stats, labels, most, folds, held))

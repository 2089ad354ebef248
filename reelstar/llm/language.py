"""Language identification by a byte convolutional network in numpy.

Texts are cut into windows of ``WINDOW`` bytes (whole texts, the last window
padded).  Filters of several widths run over the bytes, each is max-pooled over
its window, and a softmax layer gives the languages; a document's scores are
the softmax of its windows' mean log probabilities.  Weights are trained on a
sample of windows whose size is a parameter; applying them is a few table
look-ups per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from reelstar.llm import textscan as T
from reelstar.llm.folds import fold, smallest

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
UNKNOWN = "und"
# byte classes: 0 for anything but letters, a-z, and every byte from 0x80 on
CLASS = np.zeros(256, np.int32)
CLASS[97:123] = CLASS[65:91] = np.arange(1, 27)
CLASS[128:] = np.arange(27, 155)
CLASSES = 155


def windows(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class matrix (windows x WINDOW + 3) and the document of each window; windows without a letter are left out."""
    size = np.diff(offs)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), n)
    first = np.repeat(np.cumsum(n) - n, n)
    start = offs[row] + (np.arange(len(row)) - first) * WINDOW
    at = start[:, None] + np.arange(WINDOW + max(WIDTHS) - 1)
    inside = (at < offs[row + 1][:, None]) & (np.arange(at.shape[1]) < WINDOW)
    out = np.where(inside, CLASS[buf[np.minimum(at, max(len(buf) - 1, 0))]], 0) if len(row) else np.zeros(at.shape, np.int32)
    keep = out.any(axis=1)
    return out[keep], row[keep]


@dataclass
class Net:
    taps: list[np.ndarray]   # per width: (width, CLASSES, FILTERS)
    out: np.ndarray          # (features, languages)
    bias: np.ndarray
    langs: list[str]

    def prepare(self) -> None:
        """Tables of byte pairs, so that a filter of width 4 is two look-ups."""
        t2, t3, t4 = self.taps
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(CLASSES * CLASSES, FILTERS)
        self.first = np.concatenate([pair(t2[0], t2[1]), pair(t3[0], t3[1]), pair(t4[0], t4[1])], 1).astype(np.float32)
        self.third = t3[2].astype(np.float32)
        self.second = pair(t4[2], t4[3]).astype(np.float32)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        if not hasattr(self, "first"):
            self.prepare()
        out = np.zeros((len(x), len(WIDTHS) * FILTERS), np.float32)
        for a in range(0, len(x), 64):
            c = x[a:a + 64]
            ab = c[:, :-1] * CLASSES + c[:, 1:]
            r = self.first[ab[:, :WINDOW]]
            r[:, :, FILTERS:2 * FILTERS] += self.third[c[:, 2:WINDOW + 2]]
            r[:, :, 2 * FILTERS:] += self.second[ab[:, 2:WINDOW + 2]]
            out[a:a + 64] = r.max(axis=1)
        return out

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        return _log_softmax(np.tanh(self.pooled(x)) @ self.out + self.bias)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 8, batch: int = 128, rate: float = 0.01) -> Net:
    """Adam on the cross entropy; gradients of the pooling go to each filter's best place."""
    rng = np.random.default_rng(7)
    k = len(langs)
    p = [rng.normal(0, 0.3, (w, CLASSES, FILTERS)) for w in WIDTHS]
    p += [rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, k)), np.zeros(k)]
    m1, m2 = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    weight = len(y) / (k * np.maximum(np.bincount(y, minlength=k), 1))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            c, t = x[order[a:a + batch]], y[order[a:a + batch]]
            n = len(c)
            best, pooled = [], []
            for w, taps in zip(WIDTHS, p):
                r = sum(taps[i][c[:, i:i + WINDOW]] for i in range(w))
                best.append(r.argmax(axis=1))
                pooled.append(r.max(axis=1))
            h = np.tanh(np.concatenate(pooled, 1))
            d = np.exp(_log_softmax(h @ p[-2] + p[-1]))
            d[np.arange(n), t] -= 1
            d *= (weight[t] / n)[:, None]
            g = [np.zeros_like(v) for v in p]
            g[-2], g[-1] = h.T @ d + 1e-4 * p[-2], d.sum(0)
            back = (d @ p[-2].T) * (1 - h * h)
            for wi, w in enumerate(WIDTHS):
                part = back[:, wi * FILTERS:(wi + 1) * FILTERS]
                for i in range(w):
                    seen = np.take_along_axis(c, best[wi] + i, axis=1)
                    np.add.at(g[wi][i], (seen, np.arange(FILTERS)[None, :]), part)
            step += 1
            for j, v in enumerate(p):
                m1[j] = 0.9 * m1[j] + 0.1 * g[j]
                m2[j] = 0.999 * m2[j] + 0.001 * g[j] ** 2
                v -= rate * (m1[j] / (1 - 0.9**step)) / (np.sqrt(m2[j] / (1 - 0.999**step)) + 1e-8)
    return Net(p[:3], p[3], p[4], langs)


def fit(docs: DataFrame, per_language: int = 600, each: int = 3, folds: int = 3, held: int = 1) -> Net:
    """Network of about ``per_language`` texts per language outside fold ``held``, ``each`` windows of a text.

    Rows are drawn by a hash of id and text, so null or repeated ids do not swell
    the sample, and a row that repeats whole counts once; twice ``per_language``
    times the languages are the most.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                       F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id"), folds) != held))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Net([np.zeros((w, CLASSES, FILTERS)) for w in WIDTHS], np.zeros((len(WIDTHS) * FILTERS, 1)), np.zeros(1), [UNKNOWN])
    langs = sorted(counts)
    share = F.create_map(*(F.lit(v) for k in langs for v in (k, int(min(1.0, per_language / counts[k]) * (1 << 30)))))
    h = F.xxhash64(F.lit(3), "doc_id", "text")
    chosen = smallest(rows.where(F.pmod(h, F.lit(1 << 30)) < share[F.col("lang")]), h, 2 * per_language * len(langs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(1))
            x, row = windows(buf, offs)
            last = np.searchsorted(row, np.arange(len(offs)))
            pick = np.unique(np.concatenate([np.linspace(a, b - 1, min(each, b - a)).astype(np.int64)
                                             for a, b in zip(last[:-1], last[1:]) if b > a] or [np.zeros(0, np.int64)]))
            yield pa.record_batch([batch.column(0).take(pa.array(row[pick])),
                                   pa.array([w.astype(np.uint8).tobytes() for w in x[pick]], pa.binary())], names=["lang", "x"])

    got = chosen.select("lang", "text").mapInArrow(cut, "lang string, x binary").toArrow()
    pairs = sorted(zip(got.column("x").to_pylist(), got.column("lang").to_pylist()))
    if not pairs:
        pairs = [(bytes(WINDOW + 3), langs[0])]
    x = np.frombuffer(b"".join(a for a, _ in pairs), np.uint8).reshape(len(pairs), -1).astype(np.int32)
    return train(x, np.array([langs.index(b) for _, b in pairs]), langs)


def predict(docs: DataFrame, net: Net) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``.

    A null text or one without a letter is ``und`` with score 0; other columns
    pass through, columns of these two names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)
    rest = docs.drop("lang_pred", "lang_score")
    names = rest.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = np.array([*model.value.langs, UNKNOWN], object)
        for batch in batches:
            col = batch.column(at).cast(pa.string())
            buf, offs = T.text_buffer(col)
            n = len(offs) - 1
            best, sure = np.full(n, len(langs) - 1), np.zeros(n)
            for i, j in T.row_blocks(offs, 1 << 20):
                total, seen = np.zeros((j - i, len(langs) - 1)), np.zeros(j - i)
                for a, b, x, row in _strips(buf, offs, i, j):
                    lp = model.value.log_probs(x)
                    for k in range(lp.shape[1]):
                        total[:, k] += np.bincount(row, lp[:, k], j - i)
                    seen += np.bincount(row, minlength=j - i)
                p = np.exp(_log_softmax(total / np.maximum(seen, 1)[:, None]))
                known = np.array([seen[r] > 0 and _has_letter(buf[offs[i + r]:offs[i + r + 1]]) for r in range(j - i)], bool)
                best[i:j][known], sure[i:j][known] = p.argmax(1)[known], p.max(1)[known]
            yield pa.record_batch([*batch.columns, pa.array(langs[best].tolist(), pa.string()), pa.array(sure)],
                                  names=[*names, "lang_pred", "lang_score"])

    schema = StructType([*rest.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return rest.mapInArrow(run, schema)


def _strips(buf, offs, i, j, most=1 << 20):
    """Windows of the documents i..j, a bounded number of bytes at a time."""
    if offs[j] - offs[i] <= 2 * most:
        x, row = windows(buf, offs[i:j + 1])
        yield i, j, x, row
        return
    for r in range(i, j):
        for a in range(int(offs[r]), int(offs[r + 1]), most):
            x, row = windows(buf, np.array([a, min(a + most, int(offs[r + 1]))]))
            yield r, r + 1, x, row + (r - i)


def _has_letter(part: np.ndarray) -> bool:
    if ((part | 32) - np.uint8(97) < 26).any():
        return True
    return any(map(str.isalpha, part.tobytes().decode("utf-8")))

"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic texts; all other training text is unlabelled.
A linear classifier over hashed word presence minimises

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with class prior ``pi``; where the bracket turns negative, the step goes the
other way (the non-negative estimator's correction).  Training sees at most
``positives`` + ``unlabelled`` texts (a sample by hash); scoring sees every
word of every text.  The model has ``FEATURES`` weights whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm import textscan as T
from reelstar.llm.folds import fold, sampled

BUCKETS = 1 << 18
FEATURES = 2048
_SPLIT = np.arange(256, dtype=np.uint8)
_SPLIT[65:91] += 32
_SPLIT[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def _buckets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of the words (letters and digits, A-Z lower-cased)."""
    lo = int(offs[0])
    part = _SPLIT[buf[lo:int(offs[-1])]]
    _, _, h, ptr = T.scan_words(part, offs - lo)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(ptr))
    key = np.unique(row.astype(np.int64) * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64))
    return key // BUCKETS, key % BUCKETS


@dataclass(frozen=True)
class Model:
    slot: np.ndarray      # bucket -> feature, or -1
    weight: np.ndarray
    bias: float

    def scores(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        f = self.slot[bucket]
        used = f >= 0
        z = self.bias + np.bincount(row[used], self.weight[f[used]], n)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _select(pos: list[np.ndarray], unl: list[np.ndarray]) -> np.ndarray:
    """The buckets whose document frequencies differ most for their spread."""
    p = np.bincount(np.concatenate([*pos, np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS)
    u = np.bincount(np.concatenate([*unl, np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS)
    n, m = max(len(pos), 1), max(len(unl), 1)
    both = (p + u) / (n + m)
    z = (p / n - u / m) / np.sqrt(both * (1 - both) * (1 / n + 1 / m) + 1e-9)
    z[p + u < 5] = 0
    best = np.argsort(-np.abs(z), kind="stable")[:FEATURES]
    return best[np.abs(z[best]) > 3]


def train(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, steps: int = 400, rate: float = 0.1,
          decay: float = 1e-3) -> Model:
    """Full-batch Adam on the non-negative risk with the logistic loss.

    Without positives or unlabelled texts the model scores every text 0+.
    """
    slot = np.full(BUCKETS, -1, np.int32)
    if not pos or not unl:
        return Model(slot, np.zeros(0), -40.0)
    chosen = _select(pos, unl)
    slot[chosen] = np.arange(len(chosen))

    def matrix(docs):
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        f = slot[np.concatenate(docs).astype(np.int64)]
        return row[f >= 0], f[f >= 0], len(docs)

    parts = [matrix(pos), matrix(unl)]
    k = len(chosen)
    theta, m1, m2 = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        z = [theta[k] + np.bincount(r, theta[f], n) for r, f, n in parts]

        def grad(which, outer):
            r, f, n = parts[which]
            return np.append(np.bincount(f, outer[r], k), outer.sum()) / n

        lift = grad(0, sigmoid(z[0]) - 1)                 # of R_p(+)
        pos_neg, unl_neg = grad(0, sigmoid(z[0])), grad(1, sigmoid(z[1]))
        rest = np.logaddexp(0, z[1]).mean() - prior * np.logaddexp(0, z[0]).mean()
        g = prior * lift + unl_neg - prior * pos_neg if rest >= 0 else prior * pos_neg - unl_neg
        g[:k] += decay * prior * theta[:k]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        theta -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Model(slot, theta[:k].copy(), float(theta[k]))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 12000,
        folds: int = 5, held: int = 0) -> Model:
    """Model of the rows outside fold ``held``.  ``prior`` is the toxic share of their labels.

    At most ``positives`` texts of toxic ids and ``unlabelled`` others are learned
    from, also where ids are null or repeat: rows are drawn by a hash of id and
    text, and a row that repeats whole counts once.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held)))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("int"))).first()[0] or 0.0
    toxic = known.where("toxic = 1").select("doc_id").distinct()
    toxic = sampled(toxic, [F.col("doc_id")], positives, 1)
    rows = _slim(docs).where(fold(F.col("doc_id"), folds) != held)
    both = [F.col("doc_id"), F.col("text")]
    plain = sampled(rows, both, unlabelled, 2).withColumn("positive", F.lit(False))
    # ``toxic`` holds ``positives`` ids at most, so its broadcast is bounded
    chosen = sampled(rows.join(F.broadcast(toxic), "doc_id"), both, positives, 1).withColumn("positive", F.lit(True)).unionByName(plain)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(0))
            row, bucket = _buckets(buf, offs)
            cuts = np.searchsorted(row, np.arange(len(offs)))
            sets = [bucket[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.record_batch([batch.column(1), pa.array(sets, pa.binary())], names=["positive", "buckets"])

    got = chosen.select("text", "positive").mapInArrow(features, "positive boolean, buckets binary").toArrow()
    sets = [np.frombuffer(b, "<u4") for b in got.column("buckets").to_pylist()]
    flags = got.column("positive").to_pylist()
    order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())  # the same sums in every run
    return train([sets[i] for i in order if flags[i]], [sets[i] for i in order if not flags[i]], float(prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``; a null or empty text has the score of no word.

    Extra columns pass through; a column called score is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("score")
    names = rest.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(at).cast(pa.string()))
            out = [np.zeros(0)]
            for i, j in T.row_blocks(offs, 4 << 20):
                row, bucket = _buckets(buf, offs[i:j + 1])
                out.append(held.value.scores(row, bucket, j - i))
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate(out))], names=[*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType
    return rest.mapInArrow(run, StructType([*rest.schema.fields, StructField("score", DoubleType())]))

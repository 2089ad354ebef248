"""Embedding whitening with mixed-precision eigenvectors.

Vectors are quantised to integers, so the sums, the centred cross products and
the deviations are exact whatever the number of rows: a task multiplies limbs of
20 bits in float64 blocks whose sums stay below 2**53, and Spark adds the tasks'
entries limb by limb.  Only ``dim * (dim + 1) / 2`` sums reach the driver (the
dimension bounds them, some thousands at most; the rows do not).

There, the eigenvectors of the covariance start in float32 and are corrected by
Ogita-Aishima iterations in extended precision: matrix products only, the error
squared at every step.  Eigenvalues too close for the correction form clusters;
each is rotated by the eigenvectors of its own small projected matrix, shifted
by the cluster's mean so that its inner gaps are visible.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.session import cut_lineage

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BLOCK = 4096                 # rows a product: 2**40 * BLOCK stays exact in float64
LIMB = 20                    # bits of a factor
WORD, WORDS = 40, 4          # bits and number of the words in which Spark adds
LARGEST = float(1 << 62)     # quantised entries below it are 64-bit numbers
HIGH = np.longdouble
_SUM_SCHEMA = ", ".join(f"w{k} long" for k in range(WORDS))


def _limbs(z: np.ndarray) -> list[np.ndarray]:
    """``z`` as float64 factors of ``LIMB`` bits, lowest first (the last one signed)."""
    out = []
    while len(z) and np.abs(z).max() >= 1 << LIMB:
        out.append((z & ((1 << LIMB) - 1)).astype(float))
        z = z >> LIMB
    return [*out, z.astype(float)]


def _products(left: list[np.ndarray], right: list[np.ndarray], multiply) -> np.ndarray:
    """Sum of ``multiply(a, b)`` over all pairs of limbs, as Python integers."""
    total = 0
    for j, a in enumerate(left):
        for k, b in enumerate(right):
            part = np.asarray(multiply(a, b)).astype(np.int64).astype(object)
            total = total + part * (1 << LIMB * (j + k))
    return total


def _words(values: list[int]) -> list[pa.Array]:
    """Integers as ``WORDS`` columns that Spark can add without overflow."""
    mask = (1 << WORD) - 1
    cut = [[(v >> WORD * k) & mask for v in values] for k in range(WORDS - 1)]
    return [pa.array(c, pa.int64()) for c in [*cut, [v >> WORD * (WORDS - 1) for v in values]]]


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*(F.sum(f"w{k}").alias(f"w{k}") for k in range(WORDS)))


def _number(row) -> int:
    return sum(row[f"w{k}"] << WORD * k for k in range(WORDS))


def _usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x``: vectors without a null or non-finite entry, their entries still as doubles."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) * SCALE >= LARGEST))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & ~bad)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dim) + OFFSET


@dataclass(frozen=True)
class Model:
    """Exact sums of the fit list and the leading components."""
    n: int
    sums: list[int]             # per dimension, of x
    vectors: np.ndarray         # (component, dimension), unit length
    values: np.ndarray          # eigenvalues, falling
    trace: float
    varied: np.ndarray          # components with variance

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        """``sums - n * floors``, from 0 to n - 1."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floors).astype(float) - self.rests / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.varied, self.centred(x) @ self.vectors.T / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row, the exact sum of (n * x - sums) ** 2 over the dimensions."""
        z, r, n = x - self.floors, self.rests, self.n
        if not len(z):
            return []
        if (float(n) * (float(np.abs(z).max(initial=0)) + 1)) ** 2 * max(x.shape[1], 1) < 2.0**62:
            return ((n * z - r) ** 2).sum(axis=1).tolist()
        zl, rl = _limbs(z), _limbs(r[None, :])
        squares = _products(zl, zl, lambda a, b: (a * b).sum(axis=1))
        cross = _products(zl, rl, lambda a, b: (a * b).sum(axis=1))
        own = sum(int(v) ** 2 for v in r)
        return [int(n * n * s - 2 * n * c + own) for s, c in zip(squares, cross)]


def _first_vectors(a: np.ndarray) -> np.ndarray:
    """float32 eigenvectors by falling eigenvalue, as extended-precision columns."""
    size = max(float(np.abs(a).max(initial=0)), 1e-300)
    return np.linalg.eigh((a / HIGH(size)).astype(np.float32))[1][:, ::-1].astype(HIGH)


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima correction: new vectors, eigenvalues, its size, and the
    gap below which eigenvalues count as clustered."""
    r = np.eye(len(a), dtype=HIGH) - x.T @ x
    s = x.T @ a @ x
    r, s = (r + r.T) / 2, (s + s.T) / 2     # so that a correction is a rotation to first order
    value = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(value)
    close = 2 * (np.sqrt((off * off).sum()) + np.abs(value).max(initial=0) * np.sqrt((r * r).sum()))
    gap = value[None, :] - value[:, None]
    apart = np.abs(gap) > close
    e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, value, float(np.abs(e).max(initial=0)), float(close)


def _clusters(value: np.ndarray, close: float) -> Iterator[np.ndarray]:
    order = np.argsort(-value, kind="stable")
    cuts = np.flatnonzero(value[order][:-1] - value[order][1:] > close) + 1
    for part in np.split(order, cuts):
        if len(part) > 1:
            yield part


def eigenvectors(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix
    of extended precision; equal eigenvalues have some orthonormal basis."""
    a = np.asarray(a, HIGH)
    if not len(a):
        return np.zeros(0, HIGH), np.zeros((0, 0), HIGH)
    x = _first_vectors(a)
    tiny = float(np.finfo(HIGH).eps) * len(a)
    size, before = float(np.abs(a).max()), 1.0
    for _ in range(rounds):
        x, value, moved, close = _step(a, x)
        for part in _clusters(value, close):
            mean = value[part].sum() / len(part)
            own = x[:, part].T @ (a @ x[:, part] - mean * x[:, part])
            own = (own + own.T) / 2
            inner = np.abs(own).max()
            if inner <= tiny * size:
                continue    # no gap that this precision can see
            turn = np.linalg.eigh((own / inner).astype(float))[1][:, ::-1].astype(HIGH)
            away = np.abs(np.abs(turn) - np.eye(len(part))).max()
            x[:, part] = x[:, part] @ turn
            moved = max(moved, float(away) if inner > 16 * tiny * size else 0.0)
        if moved <= 4 * tiny or before / 4 < moved < 1e-9:
            break           # at the rounding of the products
        before = moved
    x, value, _, _ = _step(a, x)
    order = np.argsort(-value, kind="stable")
    x = x[:, order]
    x = x / np.sqrt((x * x).sum(axis=0))
    return value[order], x


def _high(v: Fraction) -> np.longdouble:
    first = float(v)
    return HIGH(first) + HIGH(float(v - Fraction(first)))


def _chosen_sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """Dimension (the most frequent length), number of its vectors, their sums."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            size = np.diff(batch.column(0).offsets.to_numpy())
            for dim in np.unique(size).tolist():
                part = batch.column(0).filter(pa.array(size == dim))
                held = total.setdefault(dim, [0, np.zeros(dim, object)])
                held[0] += len(part)
                if dim:
                    for limb, half in enumerate(_limbs(_matrix(part, dim))):
                        held[1] = held[1] + half.sum(axis=0).astype(np.int64).astype(object) * (1 << LIMB * limb)
        for dim, (n, held) in total.items():
            yield pa.record_batch([pa.array([dim] * (dim + 1), pa.int32()), pa.array(range(-1, dim), pa.int32()),
                                   *_words([n, *map(int, held)])], names=["dim", "i", *(f"w{k}" for k in range(WORDS))])

    got = cut_lineage(_added(rows.select("x").mapInArrow(sums, f"dim int, i int, {_SUM_SCHEMA}"), "dim", "i"))
    best = got.where("i = -1").orderBy(F.desc("w1"), F.desc("w0"), F.desc("dim")).first()
    if best is None:
        return 0, 0, []
    held = {r["i"]: _number(r) for r in got.where(F.col("dim") == best["dim"]).collect()}  # dim + 1 rows
    return best["dim"], _number(best), [held[i] for i in range(best["dim"])]


def _cross_products(rows: DataFrame, dim: int, floors: np.ndarray) -> np.ndarray:
    """Exact sums of z z' over the rows, z = x - floors."""
    i, j = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dim, dim), object), False
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                z = _limbs(_matrix(batch.column(0).slice(a, BLOCK), dim) - floors)
                total, seen = total + _products(z, z, lambda p, q: p.T @ q), True
        if seen:
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *_words(total[i, j].tolist())],
                                  names=["i", "j", *(f"w{k}" for k in range(WORDS))])

    out = np.zeros((dim, dim), object)
    for r in _added(rows.select("x").mapInArrow(run, f"i int, j int, {_SUM_SCHEMA}"), "i", "j").collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = _number(r)
    return out


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Model:
    """Components of all usable vectors (see ``whiten``).

    Without a vector, or with vectors without entries, there is no component.
    """
    rows = _usable(embeddings)
    dim, n, sums = _chosen_sums(rows)
    if not dim:
        return Model(n, [], np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0, bool))
    z = _cross_products(rows.where(F.size("x") == dim), dim, np.array([s // n for s in sums], np.int64))
    rest = [s % n for s in sums]
    a = np.array([[_high(Fraction(int(n * z[p, q] - rest[p] * rest[q]), n * n)) for q in range(dim)] for p in range(dim)], HIGH)
    value, x = eigenvectors(a)
    trace = float(np.trace(a))
    x = x[:, :components]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])] < 0, -1, 1)  # one sign for all rows
    value = value[:components].astype(float)
    return Model(n, sums, np.ascontiguousarray(x.T.astype(float)), value, trace, value > dim * 2.0**-50 * trace)


def _identity_error(rows: DataFrame, model: Model) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = np.nan_to_num(shared.value.whiten(_matrix(batch.column(0), len(shared.value.sums))))
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = np.indices((k, k))
        yield pa.record_batch([pa.array(np.append(i.ravel(), np.full(k, -1)), pa.int32()),
                               pa.array(np.append(j.ravel(), np.arange(k)), pa.int32()),
                               pa.array(np.append(second.ravel(), first))], names=["i", "j", "v"])

    first, second = np.zeros(k), np.zeros((k, k))
    for r in rows.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["i"] < 0:
            first[r["j"]] = r["v"] / model.n
        else:
            second[r["i"], r["j"]] = r["v"] / model.n
    error = np.abs(second - np.outer(first, first) - np.eye(k))[np.ix_(model.varied, model.varied)]
    return float(error.max(initial=0))


def whiten(embeddings: DataFrame, model: Model) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, distance``:
    a row per usable vector and component.

    Left out are vectors that are null, hold a null or non-finite entry, hold an
    entry that no 64-bit number can express, or have another length than the
    most frequent one (ties: the longer).  A null vec_id stays null; repeated
    rows repeat; other columns are not read.  A component without variance has
    a null ``whitened``.  ``deviation`` is null beyond 64 bits; ``distance``,
    its root over n, is always given.  ``identity_error`` is measured on the
    whitened rows.
    """
    dim, k = len(model.sums), len(model.values)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, distance double")
    names = [c.split()[0] for c in schema.split(", ")]
    spark = embeddings.sparkSession
    if not k:
        return spark.createDataFrame([], schema)
    rows = _usable(embeddings).where(F.size("x") == dim)
    error = _identity_error(rows, model)
    shared = spark.sparkContext.broadcast(model)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                part = batch.slice(a, BLOCK)
                x = _matrix(part.column(1), dim)
                off = shared.value.deviations(x)
                at = np.repeat(np.arange(len(x)), k)
                exact = pa.array([v if v < 1 << 63 else None for v in off], pa.int64())
                far = pa.array([v ** 0.5 / shared.value.n for v in off], pa.float64())
                w = shared.value.whiten(x).ravel()
                yield pa.record_batch(
                    [part.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(at), shared.value.n)), exact.take(pa.array(at)), pa.array(w, from_pandas=True),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(len(at), error)), far.take(pa.array(at))],
                    names=names)

    return rows.mapInArrow(run, schema)

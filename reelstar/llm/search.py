"""Exact top-k inner-product search by branch and bound over ball trees.

Vectors are quantised to integers, so scores are exact.  They are dealt to
cells by their nearest centre (pilot vectors, ``PILOTS`` at most); a cell is one
or more shards of about ``SHARD_ROWS`` rows.  A shard builds a ball tree;
queries visit its nodes in the order of the bound ``q.centre + |q| * radius``
and drop a node whose bound lies below the query's current k-th score.

That score is shared by rounds.  A query starts with its k-th best score over
the pilots, which are candidates themselves.  In the first round it visits one
shard of the cell of highest bound, which raises the score; in the second it
takes the raised score to the shards of all other cells, but to those only
whose ball bound reaches it.

A task holds one shard and one block of at most about ``QUERY_BLOCK`` queries,
whatever the table's size.  Equal rows (id and vector) are counted, and as many
of them as can have a rank are kept: k.

Wide vectors, whose squared norm could leave 64-bit integers, stay out of the
trees: every pair with one is scored with Python integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.session import cut_lineage

SHARD_ROWS = 16384     # vectors per shard, about
QUERY_BLOCK = 16384    # queries that meet a shard in one task, about
QUERY_ROWS = 2048      # rows compared together: queries in a tree, vectors with pilots
PILOTS = 2048          # vectors of the common first bound, cells at most
LEAF = 128
HIT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, x, c``: floor(256 * component) as 64-bit integers, or for a wide vector its components and no ``x``.

    Left out: null vectors, null or non-finite components, null ids.  Products
    of two vectors with an ``x`` stay below 2**61.
    """
    c = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    norm = F.aggregate("c", F.lit(0.0), lambda s, v: s + (F.abs(v) * 256 + 1) * (F.abs(v) * 256 + 1))
    rows = (vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c")).withColumn("wide", norm >= 2.0**61))
    whole = F.transform("c", lambda v: F.floor(v * 256)).cast("array<long>")
    return rows.select("vec_id", F.when(~F.col("wide"), whole).alias("x"), F.when(F.col("wide"), F.col("c")).alias("c"))


def _sortable(n: int) -> bytes:
    """Bytes in the order of the integers."""
    size = (abs(n).bit_length() + 7) // 8
    raw = size.to_bytes(2, "big") + abs(n).to_bytes(size, "big")
    return b"\1" + raw if n >= 0 else b"\0" + bytes(255 - b for b in raw)


def _integers(x: list[int] | None, c: list[float] | None) -> list[int]:
    """Quantised components of any size; doubles of 2**53 or more are whole."""
    return x if c is None else [int(v) * 256 if abs(v) >= 2.0**53 else math.floor(v * 256) for v in c]


def _exact_hits(store: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """``query_id, vec_id, score, sort_key`` of each query's k best in each shard, in Python integers; no score beyond 64 bits."""
    def rows(t: pa.Table) -> list[tuple[int, list[int]]]:
        return [(i, _integers(x, c)) for i, x, c in zip(*(t.column(n).to_pylist() for n in ("vec_id", "x", "c")))]

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out, some = [], rows(left)
        for q, x in rows(right):
            scored = ((sum(a * b for a, b in zip(x, y)), i) for i, y in some if i != q)
            out += [(q, i, s if -(1 << 63) <= s < 1 << 63 else None, _sortable(s))
                    for s, i in heapq.nsmallest(k, scored, key=lambda p: (-p[0], p[1]))]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 4, types)],
                        names=["query_id", "vec_id", "score", "sort_key"])

    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    every_of = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = (store.withColumn("shard", F.pmod(F.xxhash64(F.lit(6), "vec_id", "x", "c"), F.lit(shards)).cast("int"))
             .withColumn("block", every_of(blocks)))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "x", "c"), F.lit(blocks)).cast("int"))
             .withColumn("shard", every_of(shards)))
    by = ("shard", "block")
    return dealt.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(look, HIT + ", sort_key binary")


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([_sortable(n) for n in batch.column(2).to_pylist()], pa.binary())
        yield pa.record_batch([*batch.columns, keys], names=["query_id", "vec_id", "score", "sort_key"])


def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = [np.frombuffer(b, np.int64) for b in col.to_pylist()]
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal widths; a shorter vector counts as followed by zeros."""
    w = max(a.shape[1], b.shape[1])
    return np.pad(a, ((0, 0), (0, w - a.shape[1]))), np.pad(b, ((0, 0), (0, w - b.shape[1])))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum stays below 2**53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if top < 2.0**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T  # below 2**61 in the end, so it may wrap on the way


class BallTree:
    """Nodes of (centre, radius, rows); leaves hold ``LEAF`` rows at most."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.points = x.astype(np.float64)
        self.largest = float(np.abs(self.points).max(initial=0))
        self.slack = float(np.linalg.norm(self.points, axis=1).max(initial=0)) * 1e-15 * (1000 + x.shape[1])
        self.nodes: list[tuple[np.ndarray, float, np.ndarray, int, int]] = []
        todo = [(np.arange(len(x)), None)]
        while todo:
            rows, parent = todo.pop()
            centre = self.points[rows].mean(axis=0)
            gap = np.linalg.norm(self.points[rows] - centre, axis=1)
            me = len(self.nodes)
            self.nodes.append([centre, float(gap.max()) * (1 + 1e-9) + 1e-6, rows, -1, -1])
            if parent is not None:
                self.nodes[parent[0]][3 + parent[1]] = me
            if len(rows) > LEAF:
                a = self.points[rows[gap.argmax()]]
                from_a = np.linalg.norm(self.points[rows] - a, axis=1)
                b = self.points[rows[from_a.argmax()]]
                side = self.points[rows] @ (b - a)
                order = np.argsort(side, kind="stable")
                half = len(rows) // 2
                todo += [(rows[order[:half]], (me, 0)), (rows[order[half:]], (me, 1))]

    def search(self, ids: np.ndarray, q: np.ndarray, qid: np.ndarray, floor: np.ndarray, k: int):
        """Hits (query place, row, score) that may belong to the k best; ``floor`` is raised in place."""
        qf = q.astype(np.float64)
        norm = np.linalg.norm(qf, axis=1)
        lowest = np.iinfo(np.int64).min
        small = float(np.abs(q).max(initial=0)) * self.largest * max(q.shape[1], 1) < 2.0**53   # doubles hold every sum
        best = np.full((len(q), k), lowest, np.int64)   # scores
        who = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
        todo = [(0, np.arange(len(q)))]
        while todo:
            node, some = todo.pop()
            centre, radius, rows, left, right = self.nodes[node]
            bound = qf[some] @ centre + norm[some] * radius
            some = some[bound + norm[some] * self.slack + 1e-3 >= np.maximum(floor[some], best[some, -1])]
            if not len(some):
                continue
            if left >= 0:
                near = qf[some] @ (self.nodes[left][0] - self.nodes[right][0]) \
                    + norm[some] * (self.nodes[left][1] - self.nodes[right][1]) >= 0
                for group, order in ((some[near], (right, left)), (some[~near], (left, right))):
                    if len(group):
                        todo += [(n, group) for n in order]
                continue
            s = (qf[some] @ self.points[rows].T).astype(np.int64) if small else _scores(q[some], self.x[rows])
            s[ids[rows][None, :] == qid[some][:, None]] = lowest
            # only queries with a row that may enter their k best are sorted
            gains = s.max(axis=1) >= np.maximum(floor[some], best[some, -1])
            some, s = some[gains], s[gains]
            all_s = np.concatenate([best[some], s], axis=1)
            all_w = np.concatenate([who[some], np.broadcast_to(ids[rows], s.shape)], axis=1)
            order = np.lexsort((all_w, ~all_s), axis=1)[:, :k]
            best[some] = np.take_along_axis(all_s, order, 1)
            who[some] = np.take_along_axis(all_w, order, 1)
        np.maximum(floor, best[:, -1], out=floor)
        at, col = np.nonzero((best > lowest) & (best >= floor[:, None]))
        return at, who[at, col], best[at, col]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of each query among all other rows.

    Queries are the rows whose id is divisible by ``every``.  Ties go to the
    smaller vec_id; fewer candidates give fewer rows; no vector, no row.
    Repeated ids: each row is a candidate, a query never meets its own id, and
    of equal (id, score) rows each has its own rank.  A score beyond 64 bits is
    ranked by its exact value and returned as null.
    """
    spark = vectors.sparkSession
    every_row = cut_lineage(quantised(vectors))
    n, n_wide = every_row.agg(F.count("x"), F.count("c")).first()
    rows, wide = every_row.where(F.col("x").isNotNull()), every_row.where(F.col("c").isNotNull())
    hits = _narrow_hits(rows.select("vec_id", "x"), n, k, every) if n else spark.createDataFrame([], HIT)
    order = "score"
    if n_wide:
        asked = F.col("vec_id") % every == 0
        hits = (hits.mapInArrow(_with_keys, HIT + ", sort_key binary")
                .unionByName(_exact_hits(every_row, wide.where(asked).distinct(), math.ceil((n + n_wide) / SHARD_ROWS), k))
                .unionByName(_exact_hits(wide, rows.where(asked).distinct(), math.ceil(n_wide / SHARD_ROWS), k)))
        order = "sort_key"
    best = Window.partitionBy("query_id").orderBy(F.col(order).desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


LOWEST = np.iinfo(np.int64).min
ASKED = "vec_id long, x binary, floor long, shard long"
STATE = ASKED + ", ids array<long>, scores array<long>"


def _blocks(queries: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the ``block`` that their (shard, block) task needs; a shard no query asks for drops out."""
    counts = queries.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    asked = queries.join(counts, "shard").withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.col("blocks"))).drop("blocks")
    dealt = store.join(counts, "shard").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    return asked, dealt


def _visit(queries: DataFrame, store: DataFrame, k: int, state: bool) -> DataFrame:
    """Each (query, shard) with the hits that may belong to the k best; with ``state`` also the query and its raised floor."""
    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        qid, floor = right.column("vec_id").to_numpy(), right.column("floor").to_numpy().copy()
        ids, scores = [[] for _ in qid], [[] for _ in qid]
        if left.num_rows and right.num_rows:
            x, q = _widened(_matrix(left.column("x")), _matrix(right.column("x")))
            copies = left.column("copies").to_numpy()
            who, tree = np.repeat(left.column("vec_id").to_numpy(), copies), BallTree(np.repeat(x, copies, axis=0))
            for a in range(0, len(q), QUERY_ROWS):
                part = slice(a, a + QUERY_ROWS)
                for at, vec, score in zip(*tree.search(who, q[part], qid[part], floor[part], k)):
                    ids[a + at].append(vec)
                    scores[a + at].append(score)
        hits = [pa.array(v, pa.list_(pa.int64())) for v in (ids, scores)]
        if not state:
            return pa.table([right.column("vec_id"), *hits], names=["vec_id", "ids", "scores"])
        return pa.table([right.column("vec_id"), right.column("x"), pa.array(floor), right.column("shard"), *hits],
                        names=["vec_id", "x", "floor", "shard", "ids", "scores"])

    asked, dealt = _blocks(queries, store)
    by = ("shard", "block")
    return dealt.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(look, STATE if state else "vec_id long, ids array<long>, scores array<long>")


def _hits(visited: DataFrame) -> DataFrame:
    return (visited.select(F.col("vec_id").alias("query_id"), F.explode(F.arrays_zip("ids", "scores")).alias("h"))
            .select("query_id", F.col("h.ids").alias("vec_id"), F.col("h.scores").alias("score")))


def _narrow_hits(rows: DataFrame, n: int, k: int, every: int) -> DataFrame:
    """Hits among the ``n`` vectors of 64-bit integers that may belong to the k best."""
    spark = rows.sparkSession
    # a bounded common set: PILOTS rows of smallest hash; the first distinct ones are the cells' centres
    pilots = rows.orderBy(F.xxhash64("vec_id", "x"), "vec_id").limit(PILOTS).toArrow()
    packed_pilots = [np.array(v, np.int64).tobytes() for v in pilots.column("x").to_pylist()]
    centres = list(dict.fromkeys(packed_pilots))[:math.ceil(n / SHARD_ROWS)]
    pilot = spark.sparkContext.broadcast((pilots.column("vec_id").to_numpy(), _matrix(pa.array(packed_pilots)), _matrix(pa.array(centres))))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.array(v, np.int64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(data, pa.binary())], names=["vec_id", "x"])

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest centre of each vector, and the distance to it."""
        for batch in batches:
            for a in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                x, c = (m.astype(np.float64) for m in _widened(_matrix(part.column(1)), pilot.value[2]))
                cell = ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)
                gap = np.linalg.norm(x - c[cell], axis=1)
                yield pa.record_batch([*part.columns, pa.array(cell), pa.array(gap)], names=["vec_id", "x", "copies", "cell", "gap"])

    counted = (rows.mapInArrow(packed, "vec_id long, x binary").groupBy("vec_id", "x")
               .agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies")))
    store = cut_lineage(counted.mapInArrow(celled, "vec_id long, x binary, copies long, cell long, gap double"))
    # one row per cell: PILOTS rows at most
    found = store.groupBy("cell").agg(F.sum("copies").alias("n"), F.max("gap").alias("gap")).toArrow().sort_by("cell")
    cells = found.column("cell").to_numpy()
    parts = -(-found.column("n").to_numpy().astype(np.int64) // SHARD_ROWS)
    first = np.cumsum(parts) - parts
    radius = found.column("gap").to_numpy() * (1 + 1e-9) + 1e-6
    plan = spark.createDataFrame(pa.table([pa.array(cells), pa.array(first), pa.array(parts)], names=["cell", "first", "parts"]))
    store = (store.join(F.broadcast(plan), "cell")
             .select("vec_id", "x", "copies", (F.col("first") + F.pmod(F.xxhash64(F.lit(6), "vec_id", "x"), F.col("parts"))).alias("shard")))

    def bounds(q: np.ndarray) -> np.ndarray:
        """No score of a query with a row of a cell lies above this."""
        q, c = (m.astype(np.float64) for m in _widened(q, pilot.value[2][cells]))
        norm, far = np.linalg.norm(q, axis=1)[:, None], np.linalg.norm(c, axis=1) + radius
        return q @ c.T + norm * radius + norm * far * 1e-15 * (1000 + q.shape[1]) + 1e-3

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th score over the pilots, and a shard of the cell of highest bound."""
        ids, x, _ = pilot.value
        for batch in batches:
            for a in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                qid, own = part.column(0).to_numpy(), _matrix(part.column(1))
                s = _scores(*_widened(own, x))
                s[ids[None, :] == qid[:, None]] = LOWEST
                s.sort(axis=1)
                low = s[:, -k] if s.shape[1] >= k else np.full(len(s), LOWEST)
                cell = bounds(own).argmax(axis=1)
                yield pa.record_batch([*part.columns, pa.array(low), pa.array(first[cell] + qid // every % parts[cell])],
                                      names=["vec_id", "x", "floor", "shard"])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per other shard whose bound reaches the raised score."""
        cell_of = np.repeat(np.arange(len(parts)), parts)
        for batch in batches:
            for a in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                near = (bounds(_matrix(part.column(1))) >= part.column(2).to_numpy()[:, None])[:, cell_of]
                near[np.arange(len(near)), part.column(3).to_numpy()] = False
                for row, wanted in enumerate(near):
                    shards = np.flatnonzero(wanted)
                    if len(shards):
                        same = part.slice(row, 1).select(["vec_id", "x", "floor"]).take(pa.array(np.zeros(len(shards), np.int64)))
                        yield pa.record_batch([*same.columns, pa.array(shards)], names=["vec_id", "x", "floor", "shard"])

    queries = store.where(F.col("vec_id") % every == 0).select("vec_id", "x").mapInArrow(start, ASKED)
    visited = cut_lineage(_visit(cut_lineage(queries), store, k, True))
    other = visited.select("vec_id", "x", "floor", "shard").mapInArrow(rest, ASKED)
    return _hits(visited).unionByName(_hits(_visit(cut_lineage(other), store, k, False)))

"""N-gram Jaccard join by a MinHash LSH forest and exact verification.

1. Every text becomes its set of five-word shingles (A-Z lower-cased; a text of
   fewer words is one shingle).  Equal sets are one class of copies, counted
   map-side, so thousands of copies cost one row.
2. Each distinct set has a signature of ``DEPTH`` MinHash values in each of
   ``TREES`` trees.  A node of a tree is a run of equal signature prefixes; it
   is formed by grouping on the prefix, so no run has to fit one task.
3. Rounds go from the deepest prefixes upwards.  A round verifies the nodes of
   its depth; nodes with the members of a node already verified are passed over
   (the compressed paths of the trie).  The matched prefix is then shortened to
   the depth at which the weakest pair seen so far is found with the target
   recall, until it need not be shortened.  Pairs down to ``SLACK`` below the
   threshold count as seen at the threshold, and so does a round without any
   pair: only a corpus whose pairs are clearly closer stays at deep prefixes.
4. The sets of a node's members meet in blocks of about ``CHUNK`` sets and
   ``SHINGLES`` shingles, and every pair of a block pair is compared exactly, by
   shared-shingle counts.  A pair counts in the first round in which it meets,
   there in its smallest common node.  No pair leaves a task: only link counts
   and one connecting edge per member do.
5. Classes are the connected components (min-label star contraction, all
   joins; each round is cut to the checkpoint folder).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm import textscan as T
from reelstar.session import cut_lineage

WORDS = 5
TREES = 10
DEPTH = 6
CHUNK = 256
SHINGLES = 1 << 21   # of a block's sets; a larger set is a block of its own size
SLACK = 0.1
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_depth(similarity: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix by which pairs of ``similarity`` are found with a recall of ``target`` (1 at least)."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < target:
        depth -= 1
    return depth


def shingles(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Per document, its sorted distinct shingle hashes."""
    _, _, h, ptr = T.scan_words(buf, offs, lower=True)
    n = np.diff(ptr)
    key = h.copy()
    for k in range(1, WORDS):
        nxt = np.zeros_like(h)
        nxt[:len(h) - k] = h[k:]
        key = T.mix(key * np.uint64(T._R) + nxt)
    out = []
    for a, size in zip(ptr[:-1], n):
        if size >= WORDS:
            out.append(np.unique(key[a:a + size - WORDS + 1]))
        elif size:
            one = np.uint64(size)
            for x in h[a:a + size]:
                one = T.mix(np.array([one ^ x]) + np.uint64(0x51))[0]
            out.append(np.array([one]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _content(s: np.ndarray) -> bytes:
    """Identity of a set with a shingle."""
    return np.array([T.mix(s).sum(), T.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).tobytes()


def _min_hashes(s: np.ndarray) -> np.ndarray:
    """Signature of one set, ``TREES`` by ``DEPTH``, from a bounded number of shingles at a time."""
    best = np.full(len(_SEEDS), (1 << 64) - 1, np.uint64)
    for a in range(0, len(s), 4096):
        x = s[a:a + 4096, None] * _SEEDS
        best = np.minimum(best, ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0))
    return best.astype(np.uint32)  # the low halves; the high ones of minima are mostly zero


def _trees(signatures: list[bytes]) -> np.ndarray:
    """Signatures as an array of sets by ``TREES`` by ``DEPTH``."""
    return np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, TREES, DEPTH)


def _slim(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_id(text).alias("text_id"))


def text_id(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, content, size, signature``: set identity, number of shingles and MinHash values (null without a word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = T.text_buffer(batch.column(1))
            for i, j in T.row_blocks(offs, 2 << 20):
                sets = shingles(buf, offs[i:j + 1])
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                                       pa.array([_content(s) if len(s) else None for s in sets], pa.binary()),
                                       pa.array([len(s) for s in sets], pa.int64()),
                                       pa.array([_min_hashes(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                                      names=["doc_id", "text_id", "content", "size", "signature"])

    return _slim(docs).mapInArrow(run, "doc_id long, text_id long, content binary, size long, signature binary")


def _prefixes(depth: int):
    """``node, size, bucket`` of each tree's prefix of ``depth`` values."""
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _trees(batch.column(2).to_pylist()).astype(np.uint64)
            key = np.tile(np.arange(TREES, dtype=np.uint64) + np.uint64(TREES * depth), (len(values), 1))
            for k in range(depth):
                key = T.mix(key * np.uint64(T._R) + values[:, :, k])
            yield pa.record_batch([pa.array(np.repeat(batch.column(0).to_numpy(), TREES)),
                                   pa.array(np.repeat(batch.column(1).to_numpy(), TREES)),
                                   pa.array(key.ravel().view(np.int64))], names=["node", "size", "bucket"])

    return prefixes


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the texts whose content is the node's: another text may have the same doc_id."""
    for batch in batches:
        buf, offs = T.text_buffer(batch.column(1))
        for i, j in T.row_blocks(offs, 2 << 20):
            sets = shingles(buf, offs[i:j + 1])
            same = pa.array([len(x) > 0 and _content(x) == c for x, c in zip(sets, batch.column(2).slice(i, j - i).to_pylist())], pa.bool_())
            part = pa.record_batch([batch.column(0).slice(i, j - i), *(c.slice(i, j - i) for c in batch.columns[3:]),
                                    pa.array([x.tobytes() for x in sets], pa.binary())],
                                   names=["node", "first", "copies", "signature", "buckets", "shingles"])
            yield part.filter(same)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of shared-shingle counts; only shingles of two sets or more are laid out."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    number = np.cumsum(shared) - 1
    used = shared[code]
    row, code = row[used], number[code[used]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    width = 8192
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(code, [a, a + width])
        x = np.zeros((len(sets), width), np.float32)
        x[row[lo:hi], code[lo:hi] - a] = 1
        out += x @ x.T
    return out


def _verify(threshold: float, before: int | None):
    """Links of a block pair's sets; pairs with an equal prefix of ``before`` values met in an earlier round."""
    def verify(group: pa.Table) -> pa.Table:
        keep = np.unique(group.column("node").to_numpy(), return_index=True)[1]  # a repeated row is a counted copy
        group = group.take(pa.array(keep))
        bucket, lo, hi = (group.column(c)[0].as_py() for c in ("bucket", "lo", "hi"))
        node = group.column("node").to_numpy()
        copies = group.column("copies").to_numpy()
        chunk = group.column("chunk").to_numpy()
        buckets = group.column("buckets").to_pylist()
        trees = _trees(group.column("signature").to_pylist())
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        inter = _overlaps(sets)
        union = size[:, None] + size[None, :] - inter
        pair = node[:, None] != node[None, :]
        if lo != hi:
            pair &= (chunk[:, None] != chunk[None, :])
        near = pair & (inter >= threshold * union - 1e-9)
        seen = pair & (inter >= (threshold - SLACK) * union)
        weakest = np.where(seen, np.maximum(inter / union, threshold), 1.0).min(axis=1) if seen.any() else np.ones(len(node))
        i, j = np.nonzero(near)
        width = max(map(len, buckets))
        table = np.full((len(node), width), np.iinfo(np.int64).min, np.int64)
        for k, b in enumerate(buckets):
            table[k, :len(b)] = b
        links = np.zeros(len(node), np.int64)
        for a in range(0, len(i), 1 << 14):
            p, q = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
            common = (table[p][:, :, None] == table[q][:, None, :]).any(axis=2) & (table[p] != np.iinfo(np.int64).min)
            own = np.where(common, table[p], np.iinfo(np.int64).max).min(axis=1) == bucket
            if before is not None:
                own &= ~(trees[p, :, :before] == trees[q, :, :before]).all(axis=2).any(axis=1)
            np.add.at(links, p[own], copies[q[own]])
        root = np.arange(len(node))
        while True:  # the smallest place reachable over near pairs
            new = root.copy()
            np.minimum.at(new, i, root[j])
            new = new[new]
            if (new == root).all():
                break
            root = new
        first = group.column("first").to_numpy()
        return pa.table([pa.array(x) for x in (node, first, links, node[root], first[root], weakest, seen.any(axis=1))],
                        names=["node", "first", "links", "root", "root_first", "weakest", "seen"])

    return verify


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each edge's component.

    Alternates large-star and small-star steps until the edges no longer
    change; edges stay distributed, each round is written to the checkpoint
    folder and compared by a count and a hash sum.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        near = both.join(least, "u")
        out = near.where("v > u") if large else near
        step = out.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            step = step.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return step.where("a <> b").distinct()

    current, seen = cut_lineage(edges.where("a <> b").distinct()), None
    while True:
        current = cut_lineage(star(star(current, True), False))
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        seen = state


def similarity_classes(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies`` of every row of ``docs``.

    ``n_links`` counts the other rows whose shingle sets have a Jaccard
    similarity of ``threshold`` or more, ``class_id`` is the smallest doc_id
    of the rows connected by links.  A text without a word (or null) is linked
    to none and its class is its own id; a row with a null doc_id takes no
    part (null class, 0 links).  Repeated rows count as copies; different texts
    of one doc_id are linked each by its own content.  Other columns are not read.
    """
    return _classes(docs, threshold, recall).select("doc_id", "class_id", "n_links", "n_copies")


def representatives(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """``doc_id, text_id`` of one text of each class: of its smallest doc_id, and of the class's first content.

    Each doc_id with texts without a word has one of them; rows with a null doc_id take no part.
    """
    classes = _classes(docs, threshold, recall).where("doc_id = class_id and is_root")
    return classes.groupBy("doc_id", "content").agg(F.min("text_id").alias("text_id")).select("doc_id", "text_id")


def _nodes(places: DataFrame) -> DataFrame:
    """The trie nodes of two members or more, one of those with the same members."""
    return (places.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.bit_xor(F.xxhash64("node")).alias("h1"),
                 F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("h2"))
            .where("n > 1").groupBy("n", "size", "h1", "h2").agg(F.min("bucket").alias("bucket")))


def _round(docs: DataFrame, contents: DataFrame, threshold: float, depth: int, before: int | None, done: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Verifies the trie nodes of ``depth`` but those of ``done``: (verified nodes, links and edges found)."""
    places = contents.select("node", "size", "signature").mapInArrow(_prefixes(depth), "node long, size long, bucket long")
    ranges = _nodes(places)
    if done is not None:
        ranges = ranges.join(done.select("n", "size", "h1", "h2"), ["n", "size", "h1", "h2"], "left_anti")
    ranges = cut_lineage(ranges)
    chunks = F.least(F.col("n"), F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("size") / SHINGLES))).cast("int")
    members = places.select("node", "bucket").join(ranges.select("bucket", chunks.alias("chunks")), "bucket")
    per_node = (members.groupBy("node").agg(F.collect_list(F.struct("bucket", "chunks")).alias("ranges"))
                .join(contents.select("node", "content", "first", "copies", "signature"), "node"))
    texts = _slim(docs).select(F.col("doc_id").alias("first"), "text")
    sets = (texts.join(per_node, "first").select("node", "text", "content", "first", "copies", "signature", "ranges")
            .mapInArrow(_sets, "node long, first long, copies long, signature binary, "
                               "buckets array<struct<bucket:long,chunks:int>>, shingles binary"))
    spread = (sets.withColumn("r", F.explode("buckets"))
              .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("r.chunks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("r.chunks") - 1)))
              .select(F.col("r.bucket").alias("bucket"), F.least("chunk", "other").alias("lo"),
                      F.greatest("chunk", "other").alias("hi"), "chunk", "node", "first", "copies", "signature",
                      F.col("buckets.bucket").alias("buckets"), "shingles"))
    found = spread.groupBy("bucket", "lo", "hi").applyInArrow(
        _verify(threshold, before), "node long, first long, links long, root long, root_first long, weakest double, seen boolean")
    return ranges, cut_lineage(found)


def forest_rounds(docs: DataFrame, contents: DataFrame, threshold: float, recall: float) -> list[tuple[int, DataFrame]]:
    """(prefix depth, links and edges found) of each round."""
    out, weakest, before, done, depth = [], None, None, None, DEPTH
    while True:
        nodes, found = _round(docs, contents, threshold, depth, before, done)
        out.append((depth, found))
        done = nodes if done is None else done.unionByName(nodes)
        lowest = found.where("seen").agg(F.min("weakest")).first()[0]
        weakest = min((x for x in (weakest, lowest) if x is not None), default=None)
        need = prefix_depth(threshold if weakest is None else weakest, recall)
        if need >= depth:
            return out
        before, depth = depth, need


def _contents(rows: DataFrame) -> DataFrame:
    """The distinct sets, numbered, with their copies and smallest doc_id."""
    valid = rows.where(F.col("doc_id").isNotNull() & F.col("content").isNotNull())
    return (valid.groupBy("content", "size", "signature").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"))
            .withColumn("node", F.monotonically_increasing_id()))


def _classes(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """The rows' classes; nodes are numbers of the distinct contents, and ``is_root`` marks a class's first content."""
    rows = cut_lineage(signatures(docs))
    contents = cut_lineage(_contents(rows))
    found = reduce(DataFrame.unionByName, [f for _, f in forest_rounds(docs, contents, threshold, recall)])
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    # the doc_id goes first, so a component's smallest node has its smallest doc_id
    roots = components(found.select(F.struct("first", "node").alias("a"),
                                    F.struct(F.col("root_first").alias("first"), F.col("root").alias("node")).alias("b")))
    roots = roots.select("node.node", F.col("root.first").alias("root"))
    classes = (contents.select("content", "copies", "first", "node").join(links, "node", "left").join(roots, "node", "left")
               .select("content", F.coalesce("root", "first").alias("root"), F.col("root").isNull().alias("is_root"),
                       (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "copies"))
    return (rows.select("doc_id", "text_id", F.when(F.col("doc_id").isNotNull(), F.col("content")).alias("content"))
            .join(classes, "content", "left")
            .select("doc_id", "text_id", "content", F.coalesce("root", "doc_id").alias("class_id"),
                    F.coalesce("is_root", F.lit(True)).alias("is_root"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies")))

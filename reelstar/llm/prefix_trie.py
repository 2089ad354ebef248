"""Prefix trie of conversations rebuilt from a shared head and an own suffix.

A turn has a polynomial fingerprint, a sequence of turns the Horner product of
its turns: F(a + b) = F(a) * B**len(b) + F(b).  So a rebuilt conversation's
prefixes follow from the prefix products of its base (the head) and of its own
turns (the suffix) by arithmetic on numbers; no rebuilt text is written.  For an
own turn j after the h replaced ones,

    F(rebuilt up to j) = F(own, j) + (F(base, head) - F(own, h)) * B**(j - h),

and the parent's fingerprint is (F - turn) / B.  Four lanes modulo 2**31 - 1 are
kept as two longs.

Equality is verified: turns of one hash must be one text (texts are grouped
exactly, each group keeps the reference of its first turn), and all members of a
node must end with the same turn; as the parent follows from node and turn, the
whole sequences are equal by induction.  Where that fails, the fingerprints are
drawn anew.

Numbering and prefix products of a conversation are a scan over a range
partitioned table: every partition multiplies its own turns, and only the
product of each partition's open conversation is carried on.  So a conversation
of any length is spread over the partitions that its turns fill.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstar.session import cut_lineage

P = (1 << 31) - 1
LANES = 4
HEAD = 8            # the largest head
BRANCH = 5          # a conversation's base has the next lower multiple as its id
RUN = 4096          # nodes of a conversation in one running sum
CHUNK = 1 << 15     # bytes of an ordered list of ids in one row
TRIES = 8
NODE = ("depth", "a", "b")


def _bases(seed: int) -> list[int]:
    return [int(v) for v in np.random.default_rng(seed).integers(1 << 20, P - 1, LANES)]


def _powers(bases: list[int], n: int) -> np.ndarray:
    """(exponent 0..n, lane) by doubling."""
    out = np.ones((1, LANES), np.int64)
    step = np.array(bases, np.int64)
    while len(out) <= n:
        out = np.concatenate([out, out * step % P])
        step = step * step % P
    return out[:n + 1]


def _lanes(d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """(turn, lane) values of the turns' two 64-bit hashes."""
    u = [d.astype(np.int64).view(np.uint64) for d in (d1, d2)]
    parts = [w for d in u for w in (d >> np.uint64(33), (d >> np.uint64(2)) & np.uint64(P))]
    return np.column_stack(parts).astype(np.int64) % P


def _turn_lane(k: int) -> Column:
    d = F.col("d1" if k < 2 else "d2")
    part = F.shiftrightunsigned(d, 33) if k % 2 == 0 else F.shiftrightunsigned(d, 2).bitwiseAND(F.lit(P).cast("long"))
    return part % P


def _lane(k: int, a: str = "a", b: str = "b") -> Column:
    """Lane ``k`` of a packed fingerprint."""
    c = F.col(a if k < 2 else b)
    return F.shiftrightunsigned(c, 31) if k % 2 == 0 else c.bitwiseAND(F.lit(P).cast("long"))


def _packed(lanes: list[Column]) -> tuple[Column, Column]:
    return tuple((x * (1 << 31) + y) for x, y in (lanes[:2], lanes[2:]))


def _prefixes(t: np.ndarray, begin: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Horner products from each sequence's first turn (at ``begin``) up to every turn."""
    out, at = t.copy(), np.arange(len(t)) - begin
    step = 1
    while len(at) and step <= at.max():
        far = np.flatnonzero(at >= step)
        out[far] = (out[far] + out[far - step] * powers[step]) % P
        step *= 2
    return out


def _products(batch: pa.RecordBatch, bases: list[int]):
    """Conversation ids, first place of each turn's run in the batch, prefix products, powers."""
    conv = batch.column(0).to_numpy()
    change = np.flatnonzero(conv[1:] != conv[:-1]) + 1
    begin = np.zeros(len(conv), np.int64)
    begin[change] = change
    begin = np.maximum.accumulate(begin)
    powers = _powers(bases, len(conv))
    return conv, begin, _prefixes(_lanes(batch.column(1).to_numpy(), batch.column(2).to_numpy()), begin, powers), powers


def _open_runs(turns: DataFrame, bases: list[int]) -> dict[int, tuple[int, np.ndarray]]:
    """Per partition, turns and product of the earlier partitions' part of its first conversation.

    One row per partition reaches the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n, product = 0, np.zeros(LANES, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            conv, begin, own, powers = _products(batch, bases)
            first = int(conv[0]) if first is None else first
            size = len(conv) - int(begin[-1])
            whole = begin[-1] == 0 and conv[-1] == last     # the open run goes on through the batch
            product = (own[-1] + product * powers[size]) % P if whole else own[-1]
            n, last = (n + size if whole else size), int(conv[-1])
        if first is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([first]), pa.array([last]), pa.array([n]),
                                   pa.array([product.tolist()], pa.list_(pa.int64()))], names=["part", "first", "last", "n", "product"])

    rows = turns.select("conv_id", "d1", "d2").mapInArrow(run, "part long, first long, last long, n long, product array<long>")
    carried, conv, n, product = {}, None, 0, np.zeros(LANES, np.int64)
    for r in sorted(rows.collect(), key=lambda r: r["part"]):
        own = np.array(r["product"], np.int64)
        if r["first"] == conv:
            carried[r["part"]] = (n, product)
            if r["last"] == conv:                           # the whole partition is this conversation
                step = np.array([pow(b, r["n"], P) for b in bases], np.int64)
                n, product = n + r["n"], (own + product * step) % P
                continue
        conv, n, product = r["last"], r["n"], own
    return carried


def _scanned(turns: DataFrame, bases: list[int]) -> DataFrame:
    """``conv_id, j, d1, d2, bytes, a, b, pa, pb``: position from 1, prefix product up to the turn, B ** j."""
    carried = turns.sparkSession.sparkContext.broadcast(_open_runs(turns, bases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, product = carried.value.get(TaskContext.get().partitionId(), (0, np.zeros(LANES, np.int64)))
        last, opened = None, n > 0
        for batch in batches:
            if not len(batch):
                continue
            conv, begin, own, powers = _products(batch, bases)
            if not (opened or conv[0] == last):
                n, product = 0, np.zeros(LANES, np.int64)
            at = np.arange(len(conv)) - begin + 1
            lead = begin == 0
            scale = np.array([pow(b, n, P) for b in bases], np.int64)
            own[lead] = (own[lead] + product * powers[at[lead]]) % P
            power = powers[at]
            power[lead] = power[lead] * scale % P
            at[lead] += n
            opened, last = False, conv[-1]
            n, product = int(at[-1]), own[-1]
            pack = [x[:, k] * (1 << 31) + x[:, k + 1] for x in (own, power) for k in (0, 2)]
            yield pa.record_batch([batch.column(0), pa.array(at), *batch.columns[1:], *map(pa.array, pack)],
                                  names=["conv_id", "j", "d1", "d2", "bytes", "a", "b", "pa", "pb"])

    return turns.mapInArrow(run, "conv_id long, j long, d1 long, d2 long, bytes long, a long, b long, pa long, pb long")


def head_length(conv_id: Column) -> Column:
    """Turns that a conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)


def _members(turns: DataFrame, bases: list[int]) -> DataFrame:
    """``conv_id, depth, a, b, d1, d2, bytes, last``: a row per rebuilt conversation and prefix, the empty one too."""
    rows = cut_lineage(_scanned(turns, bases))
    h = head_length(F.col("conv_id"))
    replaced = (F.col("j") == h).cast("long")   # at most one turn of a conversation
    convs = rows.groupBy("conv_id").agg(F.max("j").alias("n"), F.sum(F.col("a") * replaced).alias("oa"), F.sum(F.col("b") * replaced).alias("ob"))
    convs = convs.select("conv_id", "n", "oa", "ob", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BRANCH).alias("base"))
    # at most HEAD turns of every possible base
    heads = (rows.where((F.col("conv_id") % BRANCH == 0) & (F.col("j") <= HEAD))
             .groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("j", "a", "b", "d1", "d2", "bytes"))).alias("head")))
    joined = convs.join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType))
    joined = joined.select("conv_id", "n", "h", "oa", "ob", head.alias("head"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest"))
    joined = joined.withColumn("taken", F.size("head").cast("long")).withColumn("end", F.try_element_at("head", F.lit(-1)))
    zero = F.lit(0).cast("long")
    joined = cut_lineage(joined.select("conv_id", "h", "oa", "ob", "head", "rest", "taken", F.coalesce("end.a", zero).alias("ha"),
                                       F.coalesce("end.b", zero).alias("hb")))
    length = F.col("taken") + F.col("rest")
    root = joined.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("d1"), zero.alias("d2"),
                         zero.alias("bytes"), (length == 0).alias("last"))
    lead = joined.select("conv_id", "rest", "taken", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.j").alias("depth"), "t.a", "t.b", "t.d1", "t.d2", "t.bytes",
        ((F.col("t.j") == F.col("taken")) & (F.col("rest") == 0)).alias("last"))
    # (head - own part replaced) / B ** h, per conversation with own turns left; a table of the inverse powers stays small
    inverse = [[pow(pow(b, e, P), -1, P) for e in range(HEAD + 1)] for b in bases]
    shift = [F.pmod(_lane(k, "ha", "hb") - _lane(k, "oa", "ob"), F.lit(P).cast("long"))
             * F.element_at(F.array(*(F.lit(v).cast("long") for v in inverse[k])), (F.col("h") + 1).cast("int")) % P for k in range(LANES)]
    sa, sb = _packed(shift)
    moved = joined.where("rest > 0").select("conv_id", "h", "taken", "rest", sa.alias("sa"), sb.alias("sb"))
    own = rows.join(moved, "conv_id").where(F.col("j") > F.col("h"))
    a, b = _packed([(_lane(k) + _lane(k, "sa", "sb") * _lane(k, "pa", "pb") % P) % P for k in range(LANES)])
    own = own.select("conv_id", (F.col("taken") + F.col("j") - F.col("h")).alias("depth"), a.alias("a"), b.alias("b"), "d1", "d2",
                     "bytes", (F.col("j") - F.col("h") == F.col("rest")).alias("last"))
    return root.unionByName(lead).unionByName(own)


def _ids_digests(ends: DataFrame) -> DataFrame:
    """Per node, lowercase SHA-256 of the ascending ids, comma-joined.

    Ranges of sorted ids are joined in parallel into rows of ``CHUNK`` bytes;
    only these follow each other into a node's digest.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, size = None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or size > CHUNK:
                    if held:
                        out.append((*node, int(held[0]), ",".join(held)))
                    node, held, size = key, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if len(out) > 1000 or out and size > CHUNK:
                yield packed(out)
                out = []
        if held:
            out.append((*node, int(held[0]), ",".join(held)))
        if out:
            yield packed(out)

    def packed(out):
        return pa.record_batch([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(zip(*out))],
                               names=[*NODE, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []

        def done(rows):
            return pa.record_batch([pa.array(c, pa.string() if k == 3 else pa.int64()) for k, c in enumerate(zip(*rows))],
                                   names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ids.encode())
            if out:
                yield done(out)
                out = []
        if node:
            yield done([*out, (*node, sha.hexdigest())])

    parts = (ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
             .mapInArrow(chunks, "depth long, a long, b long, first long, ids string"))
    return (parts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(digests, "depth long, a long, b long, ends_sha256 string"))


def _later_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``before``: the sum of ``saved`` over the same conversation's earlier nodes.

    Runs of ``RUN`` depths are added first, so no window holds more than
    ``RUN`` nodes, or a RUN-th of a conversation.
    """
    nodes = nodes.withColumn("run", F.floor(F.col("depth") / RUN).cast("long"))
    runs = nodes.groupBy("conv_id", "run").agg(F.sum("saved").alias("whole"))
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("lead"))
    inside = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return (nodes.withColumn("part", F.coalesce(F.sum("saved").over(inside), F.lit(0)))
            .join(runs, ["conv_id", "run"]).withColumn("before", F.col("lead") + F.col("part")).drop("run", "lead", "part"))


def _turns(conversations: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Turns with hashes, in order, and the exact texts with their hash and first reference."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), text("role").alias("role"),
                                text("text").alias("text"), F.monotonically_increasing_id().alias("at")).where(F.col("conv_id").isNotNull())
    hashes = [F.xxhash64(F.lit(2 * seed + k), "role", "text").alias(f"d{k + 1}") for k in (0, 1)]
    texts = rows.groupBy("role", "text").agg(F.min("at").alias("at")).select(*hashes, "at")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "at"]
    turns = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .select("conv_id", *hashes, F.octet_length("text").cast("long").alias("bytes")))
    return turns, texts


def _nodes(conversations: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, bool, list[int]]:
    bases = _bases(seed)
    turns, texts = _turns(conversations, seed)
    clash = texts.groupBy("d1", "d2").agg(F.count("at").alias("n")).where("n > 1").limit(1).count()
    members = cut_lineage(_members(cut_lineage(turns), bases))
    nodes = cut_lineage(members.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("bytes").alias("bytes"), F.min("d1").alias("d1"),
        F.max("d1").alias("e1"), F.min("d2").alias("d2"), F.max("d2").alias("e2")))
    sound = not clash and not nodes.where("d1 != e1 or d2 != e2").limit(1).count()
    return members, nodes, sound, bases


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversation c is the first h turns of c - c % 5 (truncated, as SQL does for
    negative ids), h = crc32(c) % 9, then its own turns after its first h.
    Turns are in the order of (turn, role, text), nulls first; null role or text
    reads as empty; rows with a null conv_id belong to no conversation and are
    left out; other columns are not read.  Repeated rows are repeated turns.  An
    empty table has no node.  A sum beyond 64 bits raises.
    """
    for seed in range(1, TRIES + 1):
        members, nodes, sound, bases = _nodes(conversations, seed)
        if sound:
            break
    else:
        raise RuntimeError(f"fingerprints clashed in {TRIES} draws")
    back = [pow(b, -1, P) for b in bases]
    up = _packed([F.pmod(_lane(k) - _turn_lane(k), F.lit(P).cast("long")) * back[k] % P for k in range(LANES)])
    below = F.col("depth") > 0
    nodes = nodes.select(*NODE, "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                         F.when(below, up[0]).alias("ua"), F.when(below, up[1]).alias("ub"))
    children = nodes.where(below).groupBy((F.col("depth") - 1).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(children, list(NODE), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    # a node belongs to its smallest member, whose later nodes belong to it too: all that a conversation owns
    # lies below its other nodes
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    sums = (members.join(owned.where("saved > 0 or leaves > 0"), "conv_id").groupBy(*NODE)
            .agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves")))
    ends = _ids_digests(members.where("last"))
    first = nodes.where("depth = 0").select("conv_id").first()
    parents = nodes.where(below).select(*NODE, F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.where("depth > 1").select(*NODE, (F.col("depth") - 1).alias("ud"), "ua", "ub")
    named = deep.join(parents.select(F.col("depth").alias("ud"), F.col("a").alias("ua"), F.col("b").alias("ub"), "parent_conv_id"),
                      ["ud", "ua", "ub"]).select(*NODE, "parent_conv_id")
    out = (_later_sums(nodes).join(sums, list(NODE), "left").join(ends, list(NODE), "left").join(named, list(NODE), "left"))
    root = F.lit(first["conv_id"] if first else None).cast("long")
    return out.select("conv_id", "depth", F.when(F.col("depth") == 1, root).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
                      "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
                      (F.coalesce("all_saved", F.lit(0).cast("long")) - F.col("before")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))

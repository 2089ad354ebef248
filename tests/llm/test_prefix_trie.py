"""The prefix trie against a trie built from texts in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reelstar.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, at long, n_convs int"


def _plain(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])
        built[c] = tuple(base[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, convs in members.items():
        inside = [n for n in members if n[:len(node)] == node]
        kids = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        leaves = [n for n in inside if not any(len(m) == len(n) + 1 and m[:-1] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in inside if n)
        ends = ",".join(str(c) for c in sorted(c for c in convs if built[c] == node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, prefix_trie.trie(df).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = ["hi", "ñ", "", None, "go on", "東京", "hi "]
    out = []
    for c in [*range(-12, 40), 400, 403, 404, 10**12]:
        size = rng.choice([0, 1, 2, 3, 5, 8, 12])
        out += [(c, t, rng.choice(["user", "assistant"]) if t % 4 else "user", rng.choice(texts[:2 + t % 6])) for t in range(size)]
    out += [(50 + 5 * k, t, "user", f"same {t}") for k in range(20) for t in range(10)]      # exact copies
    out += [(200, 0, "user", "hi"), (200, 0, "user", "hi"), (200, None, None, "first"), (200, 0, "a", "hi"), (200, 7, "", None)]
    return [*out, (None, 0, "user", "no one's"), (None, None, None, None)]


def test_trie_equals_plain_python(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    assert _got(spark, rows) == _plain(rows)


def test_one_conversation_over_many_partitions_and_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 50)
    long_one = [(5, t, "user", f"t{t % 7}") for t in range(700)]
    rows = [(1, 0, "user", "x"), *long_one, *((6, t, "user", f"t{t % 7}") for t in range(650)), (9, 0, "user", "y")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _got(spark, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == _plain(rows)


def test_clashing_fingerprints_are_found_and_drawn_anew(spark, rows, monkeypatch):
    draws = []

    def turns(conversations, seed, real=prefix_trie._turns):
        draws.append(seed)
        out, texts = real(conversations, seed)
        if seed == 1:       # every turn looks alike
            out, texts = (t.withColumn("d1", t.d1 * 0).withColumn("d2", t.d2 * 0) for t in (out, texts))
        return out, texts

    monkeypatch.setattr(prefix_trie, "_turns", turns)
    assert _got(spark, rows[:60]) == _plain(rows[:60])
    assert draws == [1, 2]


def test_weak_products_are_found(spark, monkeypatch):
    """With B = 0 a product forgets all turns but the last, so nodes end alike but products of other lengths meet."""
    monkeypatch.setattr(prefix_trie, "TRIES", 2)
    real = prefix_trie._bases
    monkeypatch.setattr(prefix_trie, "_bases", lambda seed: [1] * prefix_trie.LANES if seed == 1 else real(seed))
    rows = [(0, 0, "u", "a"), (0, 1, "u", "b"), (10**9 + 5, 0, "u", "b"), (10**9 + 5, 1, "u", "a")]  # B = 1 forgets the order
    assert _got(spark, rows) == _plain(rows)


def test_empty_and_single(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(None, 1, "user", "a")]) == []
    assert _got(spark, [(7, 0, None, None)]) == _plain([(7, 0, None, None)])

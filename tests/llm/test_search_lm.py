"""Ball-tree search and language-model scores against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from reelstar.llm import search, suffix_tree


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 300)
    monkeypatch.setattr(search, "PILOTS", 40)
    monkeypatch.setattr(search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(search, "LEAF", 16)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(0, 0.2, 8)], 1) for i in range(1200)]
    rows += [(2000 + i, rows[i % 40][1], 1) for i in range(300)]  # ties
    rows += [(3000, None, 1), (3050, [1.0, None], 1), (3100, [float("nan")] * 8, 1), (3150, [float("inf")] * 8, 1), (3200, [0.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int").repartition(3)
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    want = []
    for i, q in good:
        if i % 50 == 0:
            best = sorted(((-int(q @ x), j) for j, x in good if j != i))[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, search.top_k(df).collect())) == sorted(want)


def test_clustered_vectors_and_repeated_rows(spark, monkeypatch):
    """Tight clusters, a third of all rows one row, a query id with several vectors, a vector of another width."""
    for name, value in (("SHARD_ROWS", 50), ("PILOTS", 30), ("QUERY_BLOCK", 3), ("LEAF", 8)):
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(5)
    homes = rng.normal(0, 2, (6, 4))
    rows = [(i, [float(v) for v in homes[i % 6] + rng.normal(0, 0.01, 4)]) for i in range(400)]
    rows += [(777, rows[3][1])] * 200 + [(100, [float(v) for v in rng.normal(0, 1, 4)]) for _ in range(5)] + [(150, [0.5, 0.25])]
    whole = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        hits = [(-sum(a * b for a, b in zip(x, y)), j) for x in {x for i, x in whole if i == q} for j, y in whole if j != q]
        want += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(hits)[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert sorted(map(tuple, search.top_k(df).collect())) == sorted(want)


def test_search_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert search.top_k(spark.createDataFrame([], schema)).count() == 0
    assert search.top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (7, [0.5])], schema)
    assert [tuple(r) for r in search.top_k(two).collect()] == [(0, 1, 7, 256 * 128)]


def test_large_components_count_and_do_not_overflow(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 40)
    monkeypatch.setattr(search, "LEAF", 4)
    rng = np.random.default_rng(9)
    sizes = [1.0, 2.0**21, 2.0**30, 2.0**43, 2.0**60, 1e300, 1.5e308]
    rows = [(i, [float(v) for v in rng.uniform(-1, 1, 4) * (sizes[i % 7] if i % 3 else 1.0)]) for i in range(150)]
    rows += [(200, [float("inf"), 0.0, 0.0, 0.0]), (201, None)]
    exact = [(i, [math.floor(Fraction(c) * 256) for c in v]) for i, v in rows[:150]]
    want = []
    for i, q in exact:
        if i % 50 == 0 or i % 50 == 25:
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in exact if j != i)[:5]
            want += [(i, r + 1, j, -s if -s < 1 << 63 else None) for r, (s, j) in enumerate(best)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, search.top_k(df, every=25).collect()), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    out = [(i, " ".join(rng.choice(["The", "cat", "sat", "on", "mats", "ñu"]) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    return out + [(400, None), (401, ""), (402, " \n\t"), (403, "zzz qqq " * 9000), (5, out[5][1])]


@pytest.mark.parametrize("piece, block", [(1 << 20, 16 << 20), (64, 5000)])
def test_scores(spark, texts, monkeypatch, piece, block):
    monkeypatch.setattr(suffix_tree, "PIECE", piece)        # texts of many pieces, and blocks of one text
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", block)
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in texts], "doc_id long, text string, block string, h int").repartition(3)
    tree = suffix_tree.fit(docs)
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3))
                  for r in suffix_tree.score(docs, tree).collect())
    counts, held = Counter(), {}
    tokens = {}
    for i, t in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        tokens[i] = re.findall(r"[^\x20\x09-\x0D]+", low) + [None]
        held[i] = zlib.crc32(str(i).encode()) % 7 == 2
    for i, _ in texts:
        if not held[i]:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in texts:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[i])
        raw = "".join(w + " " for w in tokens[i][:-1]).encode()
        seq = [suffix_tree.START] * suffix_tree.DEPTH + [int(suffix_tree.CLASS[b]) for b in raw] + [suffix_tree.END]
        score = float(sum(tree.byte_log_p[b] for b in raw))
        for p in range(suffix_tree.DEPTH, len(seq)):
            node = 0
            for k in range(1, suffix_tree.DEPTH + 1):
                down = int(tree.child[node, seq[p - k]])
                if down < 0:
                    break
                node = down
            score += float(tree.log_p[node, seq[p]])
        want[i, held[i], len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n, round(base, 6), round(score, 3)] += 1
    assert got == want
    assert (tree.child >= 0).sum() == len(tree.child) - 1  # every node but the root has one parent
    sums = (10.0 ** tree.log_p[:, 1:]).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3)


def test_scores_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_tree.score(docs, suffix_tree.fit(docs)).count() == 0


def test_contexts_of_a_rare_source_survive_a_hot_one(spark):
    rare = [(i, "qxzj qxjz " * 10) for i in range(6)]
    alone = spark.createDataFrame(rare, "doc_id long, text string")
    beside = alone.unionByName(spark.createDataFrame([(10 + i, "the cat sat on the mat " * 9000) for i in range(20)], "doc_id long, text string"))

    def depth(tree):
        node = 0
        for k, c in enumerate(b"zxq "):  # latest symbol first
            down = int(tree.child[node, suffix_tree.CLASS[c]])
            if down < 0:
                return k
            node = down
        return 4

    assert depth(suffix_tree.fit(alone)) == depth(suffix_tree.fit(beside)) > 0


def test_gram_scores_equal_the_whole_tree(spark):
    rng = random.Random(5)
    other = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    docs = spark.createDataFrame([(i, other[40 * i:40 * i + 300] if i % 3 else "abc hgf " * 9) for i in range(200)], "doc_id long, text string")
    tree = suffix_tree.fit(docs)
    unseen = spark.createDataFrame([(0, "abc zyx hgf"), (1, "ÿ \u6771 9"), (2, other[:99])], "doc_id long, text string")
    got = {r.doc_id: r.score for r in suffix_tree.score(unseen, tree).collect()}
    for i, text in unseen.collect():
        raw = "".join(w + " " for w in text.split()).encode()
        seq = [0] * suffix_tree.DEPTH + [int(suffix_tree.CLASS[b]) for b in raw] + [suffix_tree.END]
        want = sum(tree.byte_log_p[b] for b in raw)
        for p in range(suffix_tree.DEPTH, len(seq)):
            node = 0
            for k in range(1, suffix_tree.DEPTH + 1):
                if tree.child[node, seq[p - k]] < 0:
                    break
                node = tree.child[node, seq[p - k]]
            want += tree.log_p[node, seq[p]]
        assert got[i] == pytest.approx(want, abs=1e-3)

"""The rule ensemble: measurements against plain Python, rules against their columns, lasso conditions, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstar.llm import rule_ensemble as R
from reelstar.llm import textscan


def _plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    solid = sum(map(len, words))
    upper = len(re.findall("[A-Z]", t))
    letters = upper + len(re.findall(r"[a-z]|[^\x00-\xbf]", t))

    def share(a, b):
        return a / max(b, 1)

    def n(chars):
        return sum(t.count(c) for c in chars)

    return [len(t), len(words), len(lines), share(solid, len(words)), share(len(words), len(lines)), share(upper, letters),
            share(letters, solid), share(n("0123456789"), solid), share(n("#*$%&<>@^~=+_\\/"), len(words)), share(n("|"), len(words)),
            share(n("!?"), len(words)), share(n("."), len(words)), share(n(",;:"), len(words)),
            share(len(re.findall(r"[\x20\x09-\x0D]", t)), len(t)), share(len(set(words)), len(words)),
            share(len(lines) - len(set(lines)), len(lines))]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    words = ["the", "cat", "Ünder", "東京", "x1", "a.b", "###", "WOW!!", "|", "ещё"]
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        pool = words[5:9] if bad else words[:6] + words[9:]
        rows.append((i, "\n".join(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 6))), 0 if bad else 1))
    rows += [(1000, None, None), (1001, "", 1), (1002, " \n\t\n", 0), (None, "no id at all", 1), (5, "same id, other text", 0), (7, rows[7][1], 1)]
    return spark.createDataFrame([(*r, 9.0, "s") for r in rows], "doc_id long, text string, quality int, score double, words string")


def test_statistics_equal_plain_python(spark, docs):
    got = sorted(([r[0], *r[1:]] for r in R.statistics(docs).collect()), key=repr)
    want = sorted(([r.doc_id, *map(float, _plain(r.text))] for r in docs.collect()), key=repr)
    assert len(got) == len(want)
    assert all(g[0] == w[0] and np.allclose(g[1:], w[1:], atol=1e-12) for g, w in zip(got, want))


@pytest.mark.parametrize("text", ["ab " * 3000, "я" * 4000, "line one\nline two\nline one\n" * 200, "東京 " * 1500, " " * 5000, "x" * 999 + "\n"])
def test_texts_longer_than_a_piece(monkeypatch, text):
    buf = np.frombuffer(text.encode(), np.uint8)
    whole = R.measure(buf, np.array([0, len(buf)]))[0]
    monkeypatch.setattr(textscan, "PIECE", 1000)
    cut = R.measure(buf, np.array([0, len(buf)]))[0]
    same = [k for k, s in enumerate(R.STATISTICS) if s not in ("words", "lines", "word_chars", "words_per_line", "new_words", "old_lines")]
    assert np.allclose(whole[same], cut[same]) or " " not in text     # shares of words follow the words
    if re.search(r"[ \n]", text):
        assert np.allclose(whole[:2], cut[:2])


def test_columns_equal_the_rules(spark, docs):
    labels = docs.select("doc_id", "quality")
    stats = R.statistics(docs)
    model = R.fit(stats, labels)
    assert 0 < len(model.rules) and all(len(rule.bounds) <= 3 and w for rule, w in model.rules)
    rows = R.score(stats.withColumn("score", F.lit(5.0)), model).toPandas()
    want = model.probability(rows[list(R.STATISTICS)].to_numpy())
    assert len(rows) == docs.count() and np.allclose(rows["score"], want, atol=1e-12) and rows["score"].between(0, 1).all()


def test_held_out_rows_are_not_learned_and_well_told(spark, docs):
    stats = R.cut_lineage(R.statistics(docs))
    labels = docs.select("doc_id", "quality")
    model = R.fit(stats, labels)
    assert model == R.fit(stats.repartition(5), labels.where(F.expr("coalesce(crc32(cast(string(doc_id) as binary)) % 5, 0) != 0")))
    held = [r for r in R.score(stats, model).join(labels, "doc_id").collect()
            if r.doc_id < 600 and r.doc_id not in (5, 7) and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 90 and sum((r.score >= 0.5) == (r.quality == 1) for r in held) >= 0.97 * len(held)


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(3)
    r = rng.integers(0, 2, (500, 12)).astype(float)
    y = (rng.random(500) < R._sigmoid(2 * r[:, 0] - 2 * r[:, 1] - 0.3)).astype(float)
    w = R.lasso(r, y, 0.03, np.zeros(13), 3000)
    g = r.T @ (R._sigmoid(r @ w[:-1] + w[-1]) - y) / 500
    used = w[:-1] != 0
    assert used.sum() < 12 and np.allclose(g[used], -0.03 * np.sign(w[:-1][used]), atol=1e-5) and (np.abs(g[~used]) <= 0.03 + 1e-5).all()
    assert abs((R._sigmoid(r @ w[:-1] + w[-1]) - y).mean()) < 1e-6


def test_sample_is_bounded_whatever_repeats(spark, docs):
    many = docs.where("doc_id = 8").crossJoin(spark.range(500).select("id")).withColumn("text", F.concat("text", F.col("id").cast("string")))
    stats = R.statistics(many.drop("id").unionByName(docs))
    labels = docs.select("doc_id", "quality").unionByName(spark.createDataFrame([(8, 1)] * 300 + [(8, None), (None, 0), (9, 7)], "doc_id long, quality int"))
    x, y = R.training_rows(stats, labels, 100)
    assert len(x) <= 100 and len(y) == len(x) and set(y) <= {0.0, 1.0}


def test_nothing_to_learn(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats = R.statistics(docs)
    assert {r.score for r in R.score(stats, R.fit(stats, none)).collect()} == {0.5}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert R.assess(empty, none).count() == 0
    ones = R.fit(stats, docs.select("doc_id", F.lit(1).alias("quality")))
    assert not ones.rules and R._sigmoid(np.array([ones.bias]))[0] > 0.95

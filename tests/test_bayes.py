"""Naive Bayes tables against plain Python, beside the logistic regression on held-out reviews."""

import math
import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelstar.operators import bayes
from reelstar.operators.classify import classify_reviews
from reelstar.plans import feeds

SCHEMA = "cid long, review_str string, id_review long, label string, token string, w0 double"


def _plain(train, texts):
    def words(t):
        return re.findall(bayes.TOKENS, t or "")

    docs = Counter(c for _, c in train if c is not None)
    classes = sorted(docs)
    n = {c: Counter(w for t, k in train if k == c for w in words(t)) for c in classes}
    vocabulary = set().union(*n.values())

    def log(a, b):
        return Decimal(repr(round(math.log(a / b), 8))).quantize(Decimal("1e-8"))

    out = []
    for t in texts:
        s = [log(docs[c], sum(docs.values())) + sum((log(n[c][w] + 1, sum(n[c].values()) + len(vocabulary)) for w in words(t) if w in vocabulary),
                                                    Decimal(0)) for c in classes]
        best = min(range(len(classes)), key=lambda k: (-s[k], k))
        out.append((classes[best], float(sorted(s)[-1] - sorted(s)[-2]) if len(s) > 1 else None))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    good, bad = ["great", "Film", "ça", "東京", "10"], ["awful", "Plot", "!!", "$$$", "film"]
    out = []
    for i in range(300):
        label = rng.choice(["negative", "positive", "mixed", None])
        pool = good + ["the"] * 9 + (bad if label == "negative" else good)
        out.append((i // 2, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 30))), i, label, "x", 1.0))
    out += [(1, None, 900, "positive", "x", 1.0), (1, "", 901, None, None, None), (None, "never-seen words", None, None, "x", 1.0),
            (1, "great " * 5000, 902, None, "x", 1.0)]
    return [*out, *[(7, "great film", 950, None, "x", 1.0)] * 40]       # repeated rows


@pytest.mark.parametrize("frequent", [0, 3, 4096])
def test_scores_equal_plain_python(spark, rows, monkeypatch, frequent):
    monkeypatch.setattr(bayes, "FREQUENT", frequent)       # tokens on the broadcast side, on the other, on both
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = Counter((r.cid, r.id_review, r.label, r.token, r.w0, r.sentiment[0], r.margin) for r in bayes.classify(df, bayes.fit(df)).collect())
    told = _plain([(r[1], r[3]) for r in rows], [r[1] for r in rows])
    assert got == Counter((c, i, label, tok, w, s, m) for (c, _, i, label, tok, w), (s, m) in zip(rows, told))


def test_saved_model_scores_alike(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    model = bayes.fit(df)
    bayes.save(model, str(tmp_path / "nb"))
    again = bayes.load(spark, str(tmp_path / "nb"))
    assert again.classes == model.classes == ("mixed", "negative", "positive") and again.priors == model.priors
    assert sorted(map(repr, bayes.classify(df, model).collect())) == sorted(map(repr, bayes.classify(df, again).collect()))


def test_no_labels_one_class_and_no_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    none = bayes.classify(df, bayes.fit(df.where("label = 'nothing'")))
    assert none.count() == len(rows) and none.where("sentiment IS NOT NULL OR margin IS NOT NULL").count() == 0
    one = bayes.classify(df, bayes.fit(df.where("label = 'positive'")))
    assert {(tuple(r.sentiment), r.margin) for r in one.collect()} == {(("positive",), None)}
    assert bayes.classify(df.limit(0), bayes.fit(df)).count() == 0


def test_frequent_tokens_alone_are_broadcast(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    plan = bayes.classify(df, bayes.fit(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ResolvedHint") == 0 and plan.count("strategy=broadcast") <= 2


def test_held_out_reviews_beside_the_logistic_regression(spark):
    texts = feeds.review_texts(spark, "/root/testdata/sf0.01")
    held = F.pmod("id_review", F.lit(5)) == 0
    train = texts.where(~held & F.col("label").isNotNull())
    test = texts.where(held & F.col("label").isNotNull())
    want = {r.id_review: r.label for r in test.collect()}
    nb = {r.id_review: r.sentiment[0] for r in bayes.classify(test, bayes.fit(train)).collect()}
    lr_rows = classify_reviews(train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)).withColumn("label", F.lit(None).cast("string"))))
    lr = {r.review_id: "negative" if r.positive_review == 0 else "positive" for r in lr_rows.collect() if r.review_id in want}

    def right(said):
        return sum(said[i] == label for i, label in want.items()) / len(want)

    share = Counter(want.values())["positive"] / len(want)
    assert len(want) > 50 and right(nb) >= max(share, right(lr) - 0.05)


def test_texts_are_split_once(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    plan = bayes.classify(df, bayes.fit(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1

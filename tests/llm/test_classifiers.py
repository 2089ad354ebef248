"""Language ID and toxicity on a small fixture: learning, edge cases, passing columns."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from reelstar.llm import folds, language, toxicity

EN, FR = "the thing and the other with words ", "être où élève garçon déjà très façon "


def test_language(spark):
    rows = [(i, (EN if i % 2 else FR) * (3 + i % 5), "en" if i % 2 else "fr", "k") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    net = language.fit(docs)
    odd = [(500, None, None, "k"), (501, "", None, "k"), (502, "12 !?", None, "k"), (503, EN * 20000, None, "k"), (None, FR, None, "k")]
    got = language.predict(docs.union(spark.createDataFrame(odd, docs.schema)), net)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score"]
    by = {r.doc_id: r for r in got.collect()}
    assert [by[i].lang_pred for i in range(120)] == [r[2] for r in rows]
    assert [by[i].lang_pred for i in (500, 501, 502, 503, None)] == ["und"] * 3 + ["en", "fr"]
    assert language.predict(docs.limit(0), language.fit(docs.limit(0))).count() == 0


def test_toxicity(spark):
    rows = [(i, EN * (2 + i % 4) + f"w{i}" + (" Vile!" if i % 4 == 0 else ""), 0.7) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    odd = [(900, None, 0.1), (901, "", 0.1), (902, EN * 20000, 0.1), (903, EN * 9000 + "vile", 0.1)]
    by = {r.doc_id: r.score for r in toxicity.score(docs.union(spark.createDataFrame(odd, docs.schema)), model).collect()}
    assert [by[i] >= 0.5 for i in range(200)] == [i % 4 == 0 for i in range(200)]
    assert [by[i] >= 0.5 for i in (900, 901, 902, 903)] == [False, False, False, True]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0


def test_samples_are_bounded_where_ids_repeat(spark):
    """Half the rows under one id, a quarter under no id, and one row a thousand times."""
    rows = [(7, f"text {k}") for k in range(2000)] + [(None, f"none {k}") for k in range(1000)]
    rows += [(k, f"own {k}") for k in range(1000)] + [(8, "same")] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for seed in range(4):
        got = folds.sampled(docs, [F.col("doc_id"), F.col("text")], 300, seed).collect()
        assert 150 <= len(got) <= 300 and len(set(got)) == len(got)
        assert any(r.doc_id is None for r in got) and sum(r.doc_id == 7 for r in got) < 250
    assert folds.sampled(docs, [F.col("doc_id")], 10**6, 1).count() == len(rows)


def test_network_against_a_plain_forward_pass(spark):
    """Predictions equal windows, filters, pooling and softmax written out value by value."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice((EN if i % 2 else FR).split()) for _ in range(12 + 60 * (i == 3))), "en" if i % 2 else "fr") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language.predict(docs, net).collect()}
    for i, text, _ in rows[:6]:
        data = text.encode()
        logs = []
        for start in range(0, len(data), language.WINDOW):
            part = data[start:start + language.WINDOW]
            codes = [b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else b - 101 if b >= 128 else 0 for b in part]
            codes += [0] * (language.WINDOW + 3 - len(codes))
            if not any(codes):
                continue
            pooled = [max(sum(taps[k, codes[a + k], f] for k in range(len(taps))) for a in range(language.WINDOW))
                      for taps in net.taps for f in range(language.FILTERS)]
            z = [sum(math.tanh(v) * net.out[j, c] for j, v in enumerate(pooled)) + net.bias[c] for c in range(len(net.langs))]
            logs.append([v - math.log(sum(math.exp(u) for u in z)) for v in z])
        mean = [sum(x) / len(logs) for x in zip(*logs)]
        shares = [math.exp(m) / sum(map(math.exp, mean)) for m in mean]
        assert got[i][0] == net.langs[int(np.argmax(shares))] and abs(got[i][1] - max(shares)) < 1e-3

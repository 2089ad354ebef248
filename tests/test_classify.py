from pyspark.sql import functions as F

from reelstar.operators.classify import classify_reviews
from reelstar.plans import feeds

SF = "/root/testdata/sf0.001"


def test_classifier_trains_once_saves_and_reloads(spark, tmp_path):
    texts = feeds.review_texts(spark, SF)
    model_dir = str(tmp_path / "model")
    first = classify_reviews(texts, model_dir=model_dir)
    assert first.count() == texts.count()
    assert set(first.columns) == {"user_id", "positive_review", "review_id", "insert_date"}
    assert {r[0] for r in first.select("positive_review").distinct().collect()} <= {0, 1}
    again = classify_reviews(texts, model_dir=model_dir)   # loads the saved model
    a = sorted(map(tuple, first.collect()))
    b = sorted(map(tuple, again.collect()))
    assert a == b
    labelled = texts.where("label is not null").join(first, F.col("id_review") == F.col("review_id"))
    hits = labelled.where(((F.col("label") == "negative") & (F.col("positive_review") == 0))
                          | ((F.col("label") == "positive") & (F.col("positive_review") == 1))).count()
    assert hits / labelled.count() > 0.8      # fits its own training rows


def test_plug_in_scorer(spark):
    texts = feeds.review_texts(spark, SF)
    out = classify_reviews(texts, scorer=lambda s: ["negative" if len(t) % 2 else "positive" for t in s])
    want = texts.select((F.length("review_str") % 2 == 0).cast("int").alias("p"), "id_review")
    got = out.join(want, out.review_id == want.id_review)
    assert got.where("p != positive_review").count() == 0


def test_null_text_is_scored_as_empty(spark):
    rows = [(i, "good film" if i % 2 else "bad plot", i, "positive" if i % 2 else "negative") for i in range(20)]
    texts = spark.createDataFrame(rows + [(90, None, 90, None), (91, "", 91, None)],
                                  "cid long, review_str string, id_review long, label string")
    got = {r.review_id: r.positive_review for r in classify_reviews(texts).collect()}
    assert len(got) == 22 and got[90] == got[91]

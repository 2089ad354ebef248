"""Review sentiment classification as a Spark ML job.

The default model is tokenizer -> hashed term frequencies -> IDF -> logistic
regression, trained once on the labelled reviews and applied to all reviews
over their whole text.  A saved model is reused when its folder exists.  A
user-supplied scorer (pandas Series of texts -> Series of labels) can replace
the model; it runs batch-wise over Arrow through ``mapInPandas``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.operators.staging import classified_movie_review
from reelstar.session import ensure_checkpoint_dir

NUM_FEATURES = 1 << 18
TOKEN_PATTERN = r"\W+"
TOKENIZED = "_text_or_empty"   # the tokenizer fails on a null text


def sentiment_pipeline(text_col: str = "text", label_col: str = "label",
                       max_iter: int = 30) -> Pipeline:
    """N1-N3: tokenize, featurise, classify, map the class index back to its label."""
    indexer = StringIndexer(inputCol=label_col, outputCol="label_idx", handleInvalid="skip")
    known = SQLTransformer(statement=f"SELECT *, coalesce(`{text_col}`, '') AS {TOKENIZED} FROM __THIS__")
    tokens = RegexTokenizer(inputCol=TOKENIZED, outputCol="tokens", pattern=TOKEN_PATTERN,
                            toLowercase=False)  # cased, like the pretrained model
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=NUM_FEATURES)
    idf = IDF(inputCol="tf", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter,
                            regParam=0.01)
    return Pipeline(stages=[indexer, known, tokens, tf, idf, lr])


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def load_or_fit(spark: SparkSession, training: DataFrame | None, model_dir: str | None = None,
                **kw) -> PipelineModel:
    """N5: reuse the model saved in ``model_dir`` (a folder) or fit once and save it.

    Without ``model_dir`` it is saved to the checkpoint folder.  The saved form
    is what is used: a model just fitted holds its training summary and with it
    the session, which cannot be sent to tasks once the session has observed
    metrics.
    """
    if model_dir and _path_exists(spark, model_dir):
        return PipelineModel.load(model_dir)
    if training is None:
        raise ValueError("no saved model and no labelled rows to train one")
    model_dir = model_dir or f"{ensure_checkpoint_dir(spark)}/sentiment-{uuid.uuid4().hex}"
    sentiment_pipeline(**kw).fit(training).write().overwrite().save(model_dir)
    return PipelineModel.load(model_dir)


def score(model: PipelineModel, reviews: DataFrame, text_col: str = "text",
          out_col: str = "sentiment") -> DataFrame:
    """N4/N3: apply the fitted pipeline; the predicted label becomes a one-element
    annotation array as the finisher stage produced."""
    indexer = model.stages[0]
    labels = indexer.labels
    scored = PipelineModel(stages=model.stages[1:]).transform(reviews)
    to_label = IndexToString(inputCol="prediction", outputCol="_pred_label", labels=labels)
    scored = to_label.transform(scored)
    return scored.withColumn(out_col, F.array(F.col("_pred_label"))).drop(
        TOKENIZED, "tokens", "tf", "features", "rawPrediction", "probability", "prediction", "_pred_label")


def score_with(scorer: Callable, reviews: DataFrame, text_col: str = "text",
               out_col: str = "sentiment") -> DataFrame:
    """Plug-in scorer applied per Arrow batch (a pretrained model of the user's)."""
    schema = T.StructType(reviews.schema.fields + [T.StructField(out_col, T.ArrayType(T.StringType()))])

    def run(batches):
        for pdf in batches:
            labels = scorer(pdf[text_col])
            pdf[out_col] = [[x] if x is not None else None for x in labels]
            yield pdf

    return reviews.mapInPandas(run, schema)


def classify_reviews(texts: DataFrame, model_dir: str | None = None,
                     scorer: Callable | None = None, batch_ts=None,
                     model: PipelineModel | None = None) -> DataFrame:
    """N6: raw reviews (cid, review_str, id_review[, label, insert_date]) ->
    classified reviews (user_id, positive_review, review_id, insert_date).

    A given ``model`` is used as it is; otherwise training uses the rows that
    carry a label.  All rows are scored; a null text counts as empty.
    """
    reviews = texts.withColumnRenamed("review_str", "text")
    if scorer is not None:
        scored = score_with(scorer, reviews)
    elif model is not None:
        scored = score(model, reviews)
    else:
        training = reviews.where(F.col("label").isNotNull()) if "label" in reviews.columns else None
        model = load_or_fit(texts.sparkSession, training, model_dir)
        scored = score(model, reviews)
    return classified_movie_review(scored, batch_ts=batch_ts)

"""Corpus pipeline: language ID, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet to the shared checkpoint folder and read again as the next
stage's documents.  All stages but the last return the columns they were given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.llm import bestfit, jaccard, language, toxicity
from reelstar.session import ensure_checkpoint_dir

SURE = 0.5   # least language score that is accepted


def _set_aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column but doc_id and text under a name that no stage
    uses, and the columns that give the old names back."""
    inner = {c: c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(docs.columns)}
    return (docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inner.items())),
            [F.col(n).alias(c) for c, n in inner.items()])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a predicted language (``und`` goes) of score ``SURE`` or more.

    Null or empty texts and texts without a letter are rejected; every column
    keeps its values, whatever its name.
    """
    rows, back = _set_aside(docs)
    said = language.predict(rows, language.fit(docs.select("doc_id", "text", "lang")))
    return said.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= SURE)).select(*back)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a toxicity score under 0.5; every column keeps its values, whatever its name."""
    rows, back = _set_aside(docs)
    scored = toxicity.score(rows, toxicity.fit(rows.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.where(F.col("score") < 0.5).select(*back)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each similarity class, of its smallest doc_id.

    Of repeated rows one stays, whichever comes first where they differ in
    other columns only; different texts of one doc_id stay if they are of
    different classes; rows with a null doc_id have no class and stay.
    """
    rows, back = _set_aside(docs)
    keep = jaccard.representatives(rows.select("doc_id", "text")).select(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text"))
    known = rows.where(F.col("doc_id").isNotNull()).withColumn("_of", jaccard.text_id(F.col("text")))
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_of") == F.col("_text"))
    kept = known.join(keep, same, "left_semi").dropDuplicates(["doc_id", "_of"]).select(*back)
    return kept.unionByName(rows.where(F.col("doc_id").isNull()).select(*back))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids in sequences; every piece of every document."""
    return bestfit.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [("language ID", language_stage), ("toxicity", toxicity_stage), ("n-gram Jaccard join", jaccard_stage),
          ("best-fit packing", packing_stage)]

# A trained network and classifier decide the first two stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; returns the packed pieces."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs

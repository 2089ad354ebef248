"""Multinomial naive Bayes over reviews, as tables.

The model is a table of token weights (one row per token of the labelled
reviews, one weight per class) and the class priors; fitting is two grouped
counts and scoring a join and a sum, so no vocabulary ever reaches the driver.

Weights are fixed-point numbers (``SCALE`` digits after the point).  Their sums
are exact, so a review's scores do not depend on the order in which Spark adds
them, and an equal text has equal scores wherever it lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.session import cut_lineage

# A token is a run of letters, digits and non-ASCII characters, or a run of ASCII punctuation.
TOKENS = (r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+")
SCALE = 8
WEIGHT = f"decimal(28,{SCALE})"
FREQUENT = 4096          # tokens whose weights are broadcast
FREQUENT_CHARS = 64      # the longest of them: with FREQUENT it bounds the broadcast


@dataclass(frozen=True)
class Model:
    """Classes in alphabetical order, their log priors, and token weights.

    ``weights`` has ``token, n`` (occurrences) and one column ``w<k>`` per class.
    """
    classes: tuple[str, ...]
    priors: tuple[str, ...]
    weights: DataFrame

    def columns(self) -> list[str]:
        return [f"w{k}" for k in range(len(self.classes))]


def tokens(text: str | Column) -> Column:
    """All tokens of a text in order, cased; null or empty text has none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(TOKENS), F.lit(0))


def _log(over: Column, under: Column) -> Column:
    return F.round(F.ln(over.cast("double") / under.cast("double")), SCALE).cast(WEIGHT)


def fit(training: DataFrame, text_col: str = "review_str", label_col: str = "label", smoothing: int = 1) -> Model:
    """Model of the rows that carry a label.

    Counts are grouped per (token, class) with partial sums in every task, so a
    frequent token or a class with most of the rows is no hot key.  Only one
    row per class reaches the driver.  Without a labelled row there is no class.
    """
    rows = training.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    docs = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = tuple(sorted(docs))
    exploded = rows.select("label", F.explode(tokens("text")).alias("token"))
    per_class = [F.count_if(F.col("label") == c).alias(f"n{k}") for k, c in enumerate(classes)]
    counts = cut_lineage(exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *per_class))
    total = counts.agg(F.count(F.lit(1)).alias("v"), *(F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(len(classes)))).first()
    weights = counts.select("token", "n", *(
        _log(F.col(f"n{k}") + smoothing, F.lit(total[f"n{k}"] + smoothing * total["v"])).alias(f"w{k}") for k in range(len(classes))))
    n = sum(docs.values())
    spark = training.sparkSession
    priors = [spark.range(1).select(_log(F.lit(docs[c]), F.lit(n)).cast("string")).first()[0] for c in classes]
    return Model(classes, tuple(priors), weights)


def save(model: Model, path: str) -> None:
    """Weights and classes as Parquet tables below ``path`` (overwritten)."""
    model.weights.write.mode("overwrite").parquet(f"{path}/weights")
    rows = list(zip(range(len(model.classes)), model.classes, model.priors))
    model.weights.sparkSession.createDataFrame(rows, "k int, label string, prior string").coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")


def load(spark: SparkSession, path: str) -> Model:
    rows = sorted(map(tuple, spark.read.parquet(f"{path}/classes").collect()))
    return Model(tuple(r[1] for r in rows), tuple(r[2] for r in rows), spark.read.parquet(f"{path}/weights"))


def _weighted(exploded: DataFrame, model: Model, keys: Sequence[str]) -> DataFrame:
    """Partial score rows of a review in one pass over ``exploded`` (``keys, token, _n``):
    the weights of frequent tokens (at most FREQUENT short ones) are broadcast and
    summed at once; every other token is counted per review and meets its weight by
    a shuffle on the token, in which no token is frequent.

    A review's sum of the former travels under a text of its own that holds a
    space, as no token does, so these rows are dealt evenly and meet no weight.
    Weights are summed as whole numbers of the last digit.
    """
    cols = model.columns()
    weights = model.weights.select("token", "n", *((F.col(c) * 10 ** SCALE).cast("long").alias(c) for c in cols))
    often = (weights.where(F.length("token") <= FREQUENT_CHARS).orderBy(F.desc("n"), "token").limit(FREQUENT)
             .select("token", *cols, F.lit(True).alias("_often")))
    met = exploded.join(F.broadcast(often), "token", "left").withColumn("_rare", F.when(F.col("_often").isNull(), F.col("token")))
    near = met.groupBy(*keys, "_rare").agg(*(F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(f"_near{c}") for c in cols),
                                           F.count(F.lit(1)).alias("_count"), F.sum("_n").alias("_n"))
    dealt = near.withColumn("_at", F.coalesce("_rare", F.concat(F.lit(" "), F.col("_h").cast("string"))))
    rare = weights.select(F.col("token").alias("_at"), *cols)
    return dealt.join(rare, "_at", "left").select(
        *keys, *((F.col(f"_near{c}") + F.coalesce(F.col(c) * F.col("_count"), F.lit(0).cast("long"))).alias(c) for c in cols), "_n")


def classify(reviews: DataFrame, model: Model, text_col: str = "review_str", out_col: str = "sentiment") -> DataFrame:
    """``reviews`` without their text, plus ``out_col`` (a one-element array, as the
    finisher stage gives it) and ``margin``: by how much the best class leads the next.

    Tokens unknown to the model say nothing; a review without a known token gets
    the most frequent class; of equal classes the first by name wins.  Without a
    class both columns are null.  Rows are told apart by all their columns and
    the hash of their text; repeated rows are counted, scored once, repeated.
    """
    keys = [c for c in reviews.columns if c != text_col]
    if not model.classes:
        return reviews.select(*keys, F.lit(None).cast("array<string>").alias(out_col), F.lit(None).cast("double").alias("margin"))
    cols, own = model.columns(), [f"_k{i}" for i in range(len(keys))] + ["_h"]
    rows = reviews.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_text"))
    exploded = rows.select(*own, F.posexplode_outer(tokens("_text")).alias("_p", "token")).select(
        *own, "token", F.when(F.coalesce("_p", F.lit(0)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("_n"))
    whole = _weighted(exploded, model, own).groupBy(*own).agg(*(F.sum(c).alias(c) for c in cols), F.sum("_n").alias("_n"))
    # copies were added up: their sums and priors grow alike, so a copy's share is exact
    unit = F.lit(Decimal(1).scaleb(-SCALE))
    score = [(F.expr(f"{c} div _n").cast("decimal(20,0)") * unit).cast(WEIGHT) + F.lit(p).cast(WEIGHT) for c, p in zip(cols, model.priors)]
    ranked = F.sort_array(F.array(*(F.struct((-s).alias("s"), F.lit(k).alias("k")) for k, s in enumerate(score))))
    names = F.array(*map(F.lit, model.classes))
    told = whole.withColumn("_r", ranked).withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))))
    margin = (F.try_element_at("_r", F.lit(2))["s"] - F.element_at("_r", 1)["s"]).cast("double")
    return told.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keys)),
                       F.array(F.element_at(names, F.element_at("_r", 1)["k"] + 1)).alias(out_col), margin.alias("margin"))

"""Two-class text classification on hashed word counts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.scalars import split_on_spaces
from tallyforge.operators import sgd

# Fixed value: number of hash buckets.
BUCKETS = 10_000


def hashing_tf(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Add ``features``: counts of the space-separated words in hash buckets."""
    words = df.withColumn("words", split_on_spaces(text))
    return HashingTF(inputCol="words", outputCol="features", numFeatures=buckets).transform(words)


def label_messages(spam: DataFrame, normal: DataFrame, text: str = "text") -> DataFrame:
    return spam.select(text, F.lit(1.0).alias("label")).unionByName(normal.select(text, F.lit(0.0).alias("label")))


def spam_classifier(messages: DataFrame, iterations: int = 100) -> PipelineModel:
    """Fit on ``text`` and ``label``. Any text is scored by :func:`classify`."""
    logistic = LogisticRegression(maxIter=iterations, regParam=0.01)
    return Pipeline(stages=[logistic]).fit(hashing_tf(messages).select("features", "label"))


def classify(model: PipelineModel, messages: DataFrame) -> DataFrame:
    return model.transform(hashing_tf(messages)).drop("words", "features", "rawPrediction", "probability")


def spam_sgd(messages: DataFrame, iterations: int = 100, fraction: float = 1.0, seed: int = 0) -> sgd.LinearModel:
    """Fit on ``text`` and ``label`` by gradient steps, as an alternative to :func:`spam_classifier`."""
    return sgd.logistic_sgd(hashing_tf(messages).select("features", "label"), BUCKETS, iterations, fraction=fraction, seed=seed)


def classify_sgd(model: sgd.LinearModel, messages: DataFrame) -> DataFrame:
    return sgd.predict(model, hashing_tf(messages).drop("words"))

"""Joins in which half of all rows have one key: adaptive execution has to split that key in the final plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.terms import term_rows
from tallyforge.operators import features, graph, recommend
from tallyforge.plans.durable import materialize
from tallyforge.sources.text import parse_alias

ROWS = 60_000
# No broadcasts, and bounds that a small table reaches.
_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


@pytest.fixture
def small_bounds(spark):
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def hot(spark, column):
    """Half of the rows have the value 0; a filler makes the rows long enough to be worth splitting."""
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    return materialize(spark.range(0, ROWS, numPartitions=8).select("id", key.alias(column), F.sha2(F.col("id").cast("string"), 256).alias("filler")))


def is_split(df):
    run = df._jdf.queryExecution()
    run.toRdd().count()  # runs the plan of this very frame
    return "skew=true" in run.executedPlan().toString()


def test_aliases(spark, small_bounds):
    ratings = hot(spark, "item_id")
    lines = spark.range(0, 2000).select(F.concat_ws("\t", F.col("id") * 3, F.col("id") + 900_000).alias("value"))
    assert is_split(recommend.alias_resolve(ratings, parse_alias(lines)))


def test_popularity(spark, small_bounds):
    rows = hot(spark, "item_id").select(F.col("id").alias("user_id"), "item_id", F.lit(1).alias("cnt"), "filler")
    assert is_split(recommend.popularity_predict(rows, rows.select("user_id", "item_id")))


def test_words(spark, small_bounds):
    letters = F.translate(F.col("n").cast("string"), "0123456789", "abcdefghij")  # a term has no digits
    texts = hot(spark, "n").select("id", "filler", F.concat(F.lit("word"), letters).alias("text"))
    words = spark.createDataFrame([("worda", "lemma"), ("wordb", "other"), ("wordb", "other")], "word string, lemma string")
    assert is_split(term_rows(texts, "text", ("id", "filler"), stopwords=[], lemmas=words))
    assert is_split(term_rows(texts, "text", ("id", "filler"), stopwords=words.select("word")))


def test_categories(spark, small_bounds):
    rows = hot(spark, "kind").withColumn("kind", F.col("kind") % 1000)
    assert is_split(features.onehot_places(rows, ["kind"])[0])


def test_star_rounds(spark, small_bounds):
    links = hot(spark, "to").where("id > 0").select(F.col("id").alias("node"), F.lit(0).cast("bigint").alias("to"), "filler")
    assert is_split(graph._star_round(links.select("node", "to"), True, materialize))

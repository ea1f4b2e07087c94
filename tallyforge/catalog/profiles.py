"""Linkage profiling and column statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.registry import query, rounded, table
from tallyforge.functions.scalars import nan_to_zero
from tallyforge.operators import profiling
from tallyforge.plans.durable import materialize
from tallyforge.sources.text import with_scores

_F3 = f"f3 AS ({fx.LINKAGE})"
_LONG = f"""{_F3}, cells AS (
SELECT id_1, id_2, is_match, unnest(range(9))::INT AS pos, unnest([s0, s1, s2, s3, s4, s5, s6, s7, s8]) AS x FROM f3)"""
_SCORE = " + ".join(f"coalesce(s{i}, 0)" for i in (2, 5, 6, 7, 8))


def linkage(spark, folder):
    return fx.fixture(spark, folder, fx.LINKAGE)


@query("nan_to_zero", f"WITH {_F3} SELECT id_1, id_2, round(coalesce(s0, 0), 6) AS s0 FROM f3")
def nan_to_zero_query(spark, folder):
    nan = F.coalesce("s0", F.lit(float("nan")))
    return linkage(spark, folder).select("id_1", "id_2", rounded(nan_to_zero(nan)).alias("s0"))


@query("linkage_score", f"WITH {_F3} SELECT id_1, id_2, round({_SCORE}, 6) AS score FROM f3")
def linkage_score(spark, folder):
    pairs = profiling.scored(with_scores(linkage(spark, folder)))
    return pairs.select("id_1", "id_2", rounded("score").alias("score"))


@query("score_threshold", f"WITH {_F3} SELECT id_1, id_2, is_match AS matched FROM f3 WHERE {_SCORE} >= 2.0")
def score_threshold(spark, folder):
    pairs = profiling.scored(with_scores(linkage(spark, folder)))
    return profiling.score_threshold(pairs, 2.0).select("id_1", "id_2", "matched")


@query("threshold_confusion", f"""
WITH {_F3}, s AS (SELECT is_match AS matched, {_SCORE} AS score FROM f3)
SELECT t::DOUBLE AS threshold, matched, count(*) AS cnt FROM s, (VALUES (4.0), (2.0)) v(t) WHERE score >= t GROUP BY 1, 2""")
def threshold_confusion(spark, folder):
    pairs = profiling.scored(with_scores(linkage(spark, folder)))
    return profiling.threshold_confusion(pairs, (4.0, 2.0))


_STATS = """count(x) AS cnt, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS stdev, round(max(x), 6) AS max,
round(min(x), 6) AS min"""


def _rounded(df, columns, digits=6):
    return df.select(*[rounded(c, digits).alias(c) if c in columns else c for c in df.columns])


@query("summary_stats", f"WITH v AS (SELECT l_extendedprice AS x FROM lineitem) SELECT {_STATS} FROM v")
def summary_stats(spark, folder):
    stats = profiling.summary_stats(table(spark, folder, "lineitem"), "l_extendedprice")
    return _rounded(stats, {"mean", "stdev", "max", "min"})


@query("stats_with_missing", f"""
WITH {_LONG} SELECT is_match, pos, {_STATS}, count_if(x IS NULL)::BIGINT AS missing FROM cells GROUP BY is_match, pos""")
def stats_with_missing(spark, folder):
    stats = profiling.stats_with_missing(linkage(spark, folder), fx.SCORE_COLUMNS, by=("is_match",))
    return _rounded(stats, {"mean", "stdev", "max", "min"})


@query("stats_merged", f"""
WITH {_LONG} SELECT is_match, pos, {_STATS}, count_if(x IS NULL)::BIGINT AS missing FROM cells GROUP BY is_match, pos""")
def stats_merged(spark, folder):
    """Statistics of some rows, stored, merged with those of the others: the same as one pass over all rows."""
    rows = linkage(spark, folder).withColumn("_later", F.col(fx.SCORE_COLUMNS[0]).isNull())
    stored = materialize(profiling.stats_state(rows.where(~F.col("_later")), fx.SCORE_COLUMNS, by=("is_match",)), "stats")
    both = stored.unionByName(profiling.stats_state(rows.where("_later"), fx.SCORE_COLUMNS, by=("is_match",)))
    return _rounded(profiling.stats_of_state(profiling.merge_states(both, by=("is_match",))), {"mean", "stdev", "max", "min"})


@query("match_separation", f"""
WITH {_LONG} SELECT pos, count_if(x IS NULL)::BIGINT AS missing,
round(avg(x) FILTER (is_match) - avg(x) FILTER (NOT is_match), 6) + 0.0 AS mean_gap FROM cells GROUP BY pos""")
def match_separation(spark, folder):
    return _rounded(profiling.match_separation(linkage(spark, folder), fx.SCORE_COLUMNS, "is_match"), {"mean_gap"})


@query("group_compare", f"""
WITH {_LONG} SELECT pos, round(avg(x) FILTER (is_match), 6) AS matched_mean,
count(*) FILTER (is_match AND x IS NULL) AS matched_missing, round(avg(x) FILTER (NOT is_match), 6) AS unmatched_mean,
count(*) FILTER (NOT is_match AND x IS NULL) AS unmatched_missing FROM cells GROUP BY pos""")
def group_compare(spark, folder):
    compared = profiling.group_compare(linkage(spark, folder), fx.SCORE_COLUMNS, "is_match")
    return _rounded(compared, {"matched_mean", "unmatched_mean"})


_NETWORK_LONG = f"""n AS ({fx.NETWORK}), cells AS (
SELECT unnest(range(5))::INT AS pos, unnest([c0, c4, c5, c6, c7_constant]) AS x FROM n)"""


@query("column_moments", f"""
WITH {_NETWORK_LONG} SELECT pos, count(x) AS n, round(sum(x), 2) AS total, round(sum(x * x) / 1e6, 2) AS total_squares,
round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS stdev FROM cells GROUP BY pos""")
def column_moments(spark, folder):
    moments = profiling.column_moments(fx.fixture(spark, folder, fx.NETWORK), fx.NETWORK_NUMBERS)
    moments = moments.withColumn("total_squares", F.col("total_squares") / 1e6)
    return _rounded(_rounded(moments, {"mean", "stdev"}), {"total", "total_squares"}, 2)

"""Windows from panes and state by a function, against what batch counting gives, with restarts and late rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.sources import streams
from tallyforge.streaming import jobs, panes, states

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def parts_run(spark, tmp_path, schema, parts, transform):
    """Run a job after each part, from its checkpoint; gives the update log and the progress of all runs."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    progress = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = streams.source_parquet_files(spark, source, spark.createDataFrame([], schema).schema)
        query = jobs.run(transform(stream), jobs.batch_writer(out), state, mode="update")
        query.awaitTermination()
        progress += query.recentProgress
    return spark.read.parquet(out), progress


def direct(rows, length, slide):
    """Brute force: every window, number by number, in whole seconds."""
    size, step = panes.seconds(length), panes.seconds(slide)
    epoch = dt.datetime(1970, 1, 1)
    found = {}
    for ts, key, n in rows:
        if ts is None:
            continue
        at = int((ts - epoch).total_seconds())
        for window in range((at - size) // step + 1, at // step + 1):
            count, total = found.get((window, key), (0, 0))
            found[window, key] = count + 1, total + (n or 0)
    return {
        (epoch + dt.timedelta(seconds=w * step), epoch + dt.timedelta(seconds=w * step + size), k, *v)
        for (w, k), v in found.items()
    }


@pytest.mark.parametrize(("length", "slide"), [
    ("30 seconds", "20 seconds"), ("20 seconds", "10 seconds"), ("10 seconds", "30 seconds"), ("1 minute", "1 minute"),
    ("3 hours", "1 second"),
])
def test_windows_of_panes_equal_windows(spark, tmp_path, length, slide):
    schema = "ts timestamp, k string, n long"
    apart = (0, 1, 9, 10, 19, 20, 20, 29, 31, 59, 60, 4095, 4096, 90_000) if slide != "1 second" else (0, 7, 5000)
    rows = [(at(s), key, None if s % 3 else s - 30) for s in apart for key in ("a", "b", None)[:1 + s % 3]]
    rows += [(dt.datetime(1969, 12, 31, 23, 59, 41), "a", 5), (None, "a", 1)]
    step = lambda frame: panes.pane_sums(frame, "k", sums={"n": F.col("n")}, length=length, slide=slide)
    found = panes.windows_of_panes(step(spark.createDataFrame(rows, schema)), "k", length=length, slide=slide)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == direct(rows, length, slide)


def test_an_event_is_state_once(spark, tmp_path):
    schema = "ts timestamp, k string, n long"
    parts = [[(at(20 * s + 5 * (s % 2)), "a", s) for s in range(a, b)] for a, b in ((0, 40), (40, 41), (41, 90))]
    log, progress = parts_run(spark, tmp_path, schema, parts, lambda s: panes.pane_sums(s, "k", sums={"n": F.col("n")}))
    found = panes.windows_of_panes(jobs.latest(log, ["pane", "k"]), "k")
    everything = [row for part in parts for row in part]
    assert {tuple(r) for r in found.collect()} == direct(everything, "30 seconds", "20 seconds")
    assert max(op["numRowsTotal"] for p in progress for op in p["stateOperators"]) == len(everything)


def test_late_events_are_in_no_window_or_in_all(spark, tmp_path):
    schema = "ts timestamp, k string"
    # The watermark after the second part is 3600 - 600 - 20 seconds; a pane from 2970 to 2980 is just closed.
    parts = [[(at(3600), "a")], [(at(3600), "a")], [(at(2969), "a"), (at(2981), "a")]]
    log, progress = parts_run(spark, tmp_path, schema, parts, lambda s: panes.pane_sums(s, "k", delay="10 minutes"))
    found = panes.windows_of_panes(jobs.latest(log, ["pane", "k"]), "k").where(F.col("start") < at(3500))
    assert {(r.start, r.cnt) for r in found.collect()} == {(at(2960), 1), (at(2980), 1)}
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) == 1


def test_panes_must_subtract_exactly(spark):
    sums = panes.pane_sums(spark.createDataFrame([(START, 1.5)], "ts timestamp, x double"), sums={"x": F.col("x")})
    with pytest.raises(TypeError):
        panes.windows_of_panes(sums)
    exact = panes.pane_sums(spark.createDataFrame([(START, 1.5)], "ts timestamp, x double"), sums={"x": F.col("x").cast("decimal(9,2)")})
    assert {str(r.x) for r in panes.windows_of_panes(exact).collect()} == {"1.50"}
    empty = exact.limit(0)
    assert panes.windows_of_panes(empty).count() == 0


SCHEMA = "ts timestamp, k string, n long"


def longest():
    """Count and the number furthest from zero: a state that does not add up. A zero drops the state."""

    # Local, as executors can't import test modules.
    def fold(state, rows):
        if (rows["n"] == 0).any():
            return None
        count, far = state or (0, 0)
        numbers = [far, *(int(n) for n in rows["n"])]
        return count + len(rows), max(numbers, key=lambda n: (abs(n), n))

    return fold


@pytest.mark.parametrize("shards", [1, 3])
def test_state_by_function_after_three_restarts(spark, tmp_path, shards):
    parts = [
        [(at(1), "a", 5), (at(2), "b", -7), (at(2), None, 2)], [(at(3), "a", -6)], [], [(at(4), "a", 1), (at(4), "b", 7)],
    ]
    def transform(stream):
        return states.update_state_by_key(stream, ["k"], longest(), "cnt bigint, far bigint", shards=shards)

    log, _ = parts_run(spark, tmp_path, SCHEMA, parts, transform)
    places = ["k", states.SHARD] if shards > 1 else ["k"]
    merged = jobs.latest(log, places).where(states.LIVE).groupBy("k").agg(
        F.sum("cnt").alias("cnt"), F.max_by("far", F.struct(F.abs("far"), "far")).alias("far")
    )
    assert {tuple(r) for r in merged.collect()} == {("a", 3, -6), ("b", 2, 7), (None, 1, 2)}


def test_a_fold_may_drop_its_state(spark, tmp_path):
    def transform(stream):
        return states.update_state_by_key(stream, ["k"], longest(), "cnt bigint, far bigint")

    parts = [[(at(1), "a", 5), (at(1), "b", 4)], [(at(2), "a", 0), (at(2), "c", 0)], [(at(3), "b", 9)]]
    log, _ = parts_run(spark, tmp_path, SCHEMA, parts, transform)
    found = {tuple(r) for r in jobs.latest(log, ["k"]).collect()}
    assert found == {("a", None, None, False), ("b", 2, 9, True)}


def test_idle_state_ends_and_starts_anew(spark, tmp_path):
    def transform(stream):
        return states.update_state_by_key(
            stream, ["k"], longest(), "cnt bigint, far bigint", idle_seconds=60, delay="10 seconds"
        )

    parts = [[(at(0), "a", 5), (at(0), "b", 5)], [(at(50), "b", 1)], [(at(100), "c", 1)], [(at(101), "a", 2)]]
    log, _ = parts_run(spark, tmp_path, SCHEMA, parts, transform)
    found = {r.k: (r.cnt, r.live) for r in jobs.latest(log, ["k"]).collect()}
    assert found == {"a": (1, True), "b": (2, True), "c": (1, True)}
    assert [r.k for r in log.where(~F.col("live")).collect()] == ["a"]


def test_state_by_function_in_the_default_state_store(spark, tmp_path):
    """Sessions that were not made by build_session keep their state elsewhere; NULL numbers are a key."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)

    def fold(state, rows):
        return ((state or (0,))[0] + len(rows),)

    def transform(stream):
        return states.update_state_by_key(stream, ["n"], fold, "cnt bigint", shards=2)

    spark.conf.unset(name)
    try:
        parts = [[(at(1), "a", 5), (at(2), "b", None)], [(at(3), "c", 5), (at(3), "d", None), (at(3), "e", 7)]]
        log, _ = parts_run(spark, tmp_path, SCHEMA, parts, transform)
        found = jobs.latest(log, ["n", states.SHARD]).where(states.LIVE).groupBy("n").agg(F.sum("cnt").alias("cnt"))
        assert {tuple(r) for r in found.collect()} == {(5, 2), (None, 2), (7, 1)}
    finally:
        spark.conf.set(name, before)

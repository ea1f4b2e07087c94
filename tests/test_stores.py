"""Stores that fold their batches: what is read stays equal, what is kept does not grow, replays change nothing."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from tallyforge.sources import sinks
from tallyforge.sources.stores import BatchStore

START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def entries(path):
    return {name for name in os.listdir(path) if name.startswith("batch_id=")}


def test_folded_counters_equal_unfolded(spark, tmp_path):
    plain, folded = str(tmp_path / "plain"), str(tmp_path / "folded")
    # Key a pauses for over two days, b for exactly two, c ends early, d goes on.
    hours = {"a": (0, 60, 61), "b": (0, 48, 96), "c": (0, 1), "d": tuple(range(0, 101, 20))}
    times = sorted({h for hs in hours.values() for h in hs})
    for number, hour in enumerate(times):
        rows = [(k, n + 1, at(hour)) for n, (k, hs) in enumerate(hours.items()) if hour in hs]
        batch = spark.createDataFrame(rows, "k string, cnt long, at timestamp")
        for path, every in ((plain, None), (folded, 3)):
            sinks.sink_counter_upsert(path, ["k"], batch_time=F.col("at"), fold_every=every)(batch, number)
        found = [
            {tuple(r) for r in sinks.read_counters(spark, path, F.lit(at(hour))).collect()} for path in (plain, folded)
        ]
        assert found[0] == found[1], hour
    assert len(entries(plain)) == len(times)
    assert len(entries(folded)) <= 6
    kept = BatchStore(spark, folded, "key STRING, cnt BIGINT, batch_ts TIMESTAMP")
    sinks.fold_counters(spark, folded)
    assert {r.key for r in kept.rows().collect()} == {"a", "b", "d"}


def test_replay_before_and_after_a_fold(spark, tmp_path):
    path = str(tmp_path / "c")
    write = sinks.sink_counter_upsert(path, ["k"], batch_time=F.lit(START))
    one, two = (spark.createDataFrame([(k, n)], "k string, cnt long") for k, n in (("a", 1), ("b", 5)))

    def found():
        return {r.key: r.cnt for r in sinks.read_counters(spark, path, F.lit(at(1))).collect()}

    write(one, 0)
    write(two, 1)
    write(two, 1)
    assert found() == {"a": 1, "b": 5}
    for upto in (0, 0, 1, None):
        sinks.fold_counters(spark, path, upto)
        assert found() == {"a": 1, "b": 5}
        write(one, 0)
        write(two, 1)
        assert found() == {"a": 1, "b": 5}
    write(one, 2)
    assert found() == {"a": 2, "b": 5}


def test_a_fold_that_died_is_not_read(spark, tmp_path):
    path = str(tmp_path / "p")
    write = sinks.sink_keyed_put(path, F.col("k"), F.col("n"), "pv")
    write(spark.createDataFrame([("a", 9)], "k string, n int"), 0)
    # A snapshot without its marker, as a fold leaves it that ended halfway.
    spark.createDataFrame([("z", "pv", "0")], "key string, column string, value string").write.parquet(f"{path}/_snapshots/0")
    assert [tuple(r) for r in sinks.read_puts(spark, path).collect()] == [("a", "pv", "9")]
    sinks.fold_puts(spark, path)
    write(spark.createDataFrame([("a", 4), ("b", 1)], "k string, n int"), 1)
    assert sorted(tuple(r) for r in sinks.read_puts(spark, path).collect()) == [("a", "pv", "4"), ("b", "pv", "1")]


def test_a_reader_that_began_before_a_fold_can_end(spark, tmp_path):
    path = str(tmp_path / "p")
    write = sinks.sink_keyed_put(path, F.col("k"), F.col("n"), "pv")
    for number in range(3):
        write(spark.createDataFrame([("a", number)], "k string, n int"), number)
        before = sinks.read_puts(spark, path)
        sinks.fold_puts(spark, path)
        assert [r.value for r in before.collect()] == [str(number)]


def test_sets_merge_exactly_across_batches(spark, tmp_path):
    numbers, texts = str(tmp_path / "n"), str(tmp_path / "t")
    batches = [[0, 1, 63, 64, -1, -64, None], [1, 2**63 - 1, -(2**63), 64], [], [-1, 65, 0, 0]]
    for number, members in enumerate(batches):
        rows = spark.createDataFrame([("a", m) for m in members] + [("b", number)], "k string, m long")
        for _ in range(2):  # every batch is replayed
            sinks.sink_keyed_set(numbers, F.col("k"), F.col("m"), "u", fold_every=2)(rows, number)
            text = F.concat(F.lit("m"), F.col("m").cast("string"))
            sinks.sink_keyed_set(texts, F.col("k"), text, "u")(rows, number)
        seen = {m for batch in batches[:number + 1] for m in batch if m is not None}
        for path in (numbers, texts):
            found = {r.key: int(r.value) for r in sinks.read_set_sizes(spark, path).collect()}
            assert found == {"a": len(seen), "b": number + 1}, (path, number)


def test_a_dense_set_takes_a_row_per_word(spark, tmp_path):
    path = str(tmp_path / "n")
    sinks.sink_keyed_set(path, F.lit("k"), F.col("id"), "u")(spark.range(64_000), 0)
    assert spark.read.parquet(path).count() == 1_000
    assert sinks.read_set_sizes(spark, path).first().value == "64000"

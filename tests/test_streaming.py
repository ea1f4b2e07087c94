"""Restart, replay, late data, sinks and source options."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyforge.operators import counting
from tallyforge.sources import sinks, streams
from tallyforge.streaming import jobs

START = dt.datetime(2024, 1, 1)


def events(spark, *minutes):
    rows = [(START + dt.timedelta(minutes=m), f"k{int(m) % 2}") for m in minutes]
    return spark.createDataFrame(rows, "ts timestamp, ip_address string")


def add_file(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_restart_counts_nothing_twice(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in ((1, 2, 3), (4, 5), ()):
        add_file(events(spark, *part), source)
        stream = streams.source_parquet_files(spark, source, events(spark, 1).schema, files_per_batch=1)
        counts = stream.groupBy("ip_address").agg(F.count(F.lit(1)).alias("cnt"))
        jobs.run(counts, jobs.batch_writer(out), state, mode="update").awaitTermination()
    found = jobs.latest(spark.read.parquet(out), ["ip_address"])
    assert {r.ip_address: r.cnt for r in found.collect()} == {"k0": 2, "k1": 3}


def window_run(spark, tmp_path, *parts):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    dropped = 0
    for part in parts:
        add_file(events(spark, *part), source)
        stream = streams.source_parquet_files(spark, source, events(spark, 1).schema)
        query = jobs.run(jobs.stream_count_window(stream, delay="10 minutes"), jobs.batch_writer(out), state)
        query.awaitTermination()
        dropped += sum(
            op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
        )
    rows = spark.read.parquet(out).groupBy("start").agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("times"))
    return rows.collect(), dropped


def test_windows_are_emitted_once_when_closed(spark, tmp_path):
    rows, dropped = window_run(spark, tmp_path, (0, 1, 5), (20, 21), (60,))
    assert dropped == 0 and all(r.times == 1 for r in rows)
    # A window of 30 s every 20 s holds an event once or twice; the one at minute 60 is still open.
    assert {r.start.minute for r in rows} <= {0, 1, 4, 5, 19, 20, 21} | {59} and sum(r.n for r in rows) >= 5


def test_late_events_are_dropped(spark, tmp_path):
    rows, dropped = window_run(spark, tmp_path, (60, 61), (1, 2, 3), (120,))
    assert dropped > 0 and rows and not [r for r in rows if r.start < START + dt.timedelta(minutes=40)]


def test_word_counts_per_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for n, line in enumerate(("a b a", "a")):
        (source / f"{n}.txt").write_text(line + "\n")
        lines = streams.source_text_files(spark, str(source), files_per_batch=1)
        jobs.stream_word_count_batch(lines, out, state).awaitTermination()
    found = {(r.batch_id, r.word): r.cnt for r in spark.read.parquet(out).collect()}
    assert found == {(0, "a"): 2, (0, "b"): 1, (1, "a"): 1}


def at(hours):
    return F.lit(START + dt.timedelta(hours=hours))


def counters(spark, path, now):
    return {r.key: r.cnt for r in sinks.read_counters(spark, path, at(now)).collect()}


def test_counters_expire_after_two_days(spark, tmp_path):
    path = str(tmp_path / "c")
    batch = spark.createDataFrame([("a", "x", 2), ("b", "y", 5)], "k string, l string, cnt long")
    for batch_id, hours in ((0, 0), (1, 10), (2, 10 + 49)):
        write = sinks.sink_counter_upsert(path, ["k", "l"], batch_time=at(hours))
        write(batch if batch_id < 2 else batch.where("k = 'a'"), batch_id)
        if batch_id == 1:
            write(batch, 1)  # replay
            assert counters(spark, path, 11) == {"a:x": 4, "b:y": 10}
            assert counters(spark, path, 10 + 47) == {"a:x": 4, "b:y": 10}
            assert counters(spark, path, 10 + 49) == {}
    assert counters(spark, path, 60) == {"a:x": 2}


def test_last_put_wins(spark, tmp_path):
    path = str(tmp_path / "p")
    write = sinks.sink_keyed_put(path, sinks.put_key("k", F.lit("t1")), F.col("n"), "pv")
    for batch_id, n in ((0, 9), (1, 4), (1, 4)):
        write(spark.createDataFrame([("a", n)], "k string, n int"), batch_id)
    assert [tuple(r) for r in sinks.read_puts(spark, path).collect()] == [("a@t1", "pv", "4")]
    sizes = counting.distinct_set_size(spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int"), ["k"], "v")
    assert sizes.first().set_size == 2
    near = counting.distinct_set_size(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), ["k"], "v", True)
    assert near.first().set_size == 2


def test_console_sink(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    add_file(events(spark, 1, 2), source)
    stream = streams.source_parquet_files(spark, source, events(spark, 1).schema)
    query = sinks.sink_print(stream, 5).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2


def test_console_sink_keeps_rows_from_the_driver(spark, tmp_path, capfd):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    numbers = spark.range(0, 20_000, numPartitions=4).selectExpr("id", "repeat(md5(cast(id AS string)), 40) AS text")
    numbers.write.parquet(source)
    stream = streams.source_parquet_files(spark, source, numbers.schema)
    limit = spark.conf.get("spark.driver.maxResultSize", "1g")
    tracker = spark.sparkContext._jsc.sc().conf()
    before = tracker.get("spark.driver.maxResultSize", limit)
    tracker.set("spark.driver.maxResultSize", "2m")  # 26 MB of rows
    try:
        query = sinks.sink_print(stream, 3).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        tracker.set("spark.driver.maxResultSize", before)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 20_000
    printed = capfd.readouterr().out
    assert "Batch: 0" in printed and printed.count("|") == 3 * 4 and "only showing top 3 rows" in printed


def test_kafka_options():
    properties = {"bootstrap": "a:9092", "topic_ad": "basic", "group_ad": "g", "partitions": "3"}
    assert streams.kafka_options(properties, topic_key="topic_ad", group_key="group_ad") == {
        "kafka.bootstrap.servers": "a:9092", "subscribe": "basic", "groupIdPrefix": "g", "minPartitions": "3",
    }


def test_socket_source_is_lines(spark):
    # Reading the plan opens no connection; only starting the query would.
    lines = streams.source_socket(spark, "localhost", 9)
    assert lines.isStreaming and lines.columns == ["line"]


def test_stream_stream_join(spark, tmp_path):
    left, right, out, state = (str(tmp_path / n) for n in ("l", "r", "out", "state"))
    add_file(events(spark, 0, 2, 4), left)
    add_file(events(spark, 0, 2.1, 9), right)
    schema = events(spark, 1).schema
    pairs = jobs.joined_streams(*[streams.source_parquet_files(spark, p, schema) for p in (left, right)], key="ip_address")
    rows = pairs.select(F.col("a.ts").alias("x"), F.col("b.ts").alias("y"))
    jobs.run(rows, jobs.batch_writer(out), state).awaitTermination()
    assert [(r.x.minute, r.y.minute) for r in spark.read.parquet(out).orderBy("x").collect()] == [(0, 0), (2, 2)]


def test_empty_batch_adds_no_counter(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    (source / "0.txt").write_text('{"type":"ad_log","payload":{"time":"2024-01-01 00:09:00","os":"i"}}\n')
    for n in range(2):
        (source / f"{n + 1}.txt").write_text("{bad\n")
        lines = streams.source_text_files(spark, str(source), files_per_batch=1)
        jobs.stream_ad_cube(lines, out, state).awaitTermination()
    found = sinks.read_counters(spark, out).collect()
    assert len(found) == 32 and {r.cnt for r in found} == {1}

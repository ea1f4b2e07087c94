"""Streaming jobs: each is a batch operator, a way to keep state, and a restartable run.

Windows use event time. ``delay`` is how late an event may be; later ones are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.functions.adlogs import read_ad_log
from tallyforge.operators import access_log
from tallyforge.operators.counting import topk_per_group, word_count
from tallyforge.operators.cube import AD_DIMENSIONS, AD_FIXED, ad_cube
from tallyforge.plans.durable import materialize
from tallyforge.sources.sinks import sink_counter_upsert
from tallyforge.sources.stores import replace_batch

# Batch intervals, and length and step of the two kinds of window.
AD_INTERVAL, WORD_INTERVAL, STATE_INTERVAL = "60 seconds", "30 seconds", "10 seconds"
COUNT_WINDOW, COUNT_SLIDE = "30 seconds", "20 seconds"
REPORT_WINDOW, REPORT_SLIDE = "20 seconds", "10 seconds"

BatchWriter = Callable[[DataFrame, int], None]


def run(
    stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append", interval: str | None = None
) -> StreamingQuery:
    """Start a job that goes on from ``checkpoint`` if it was run before.

    With an ``interval`` it runs until stopped, otherwise it works off what is there and ends.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Write the (transformed) rows of each batch to a folder of their own, replaced if the batch is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch if transform is None else transform(batch), batch_id, path)

    return write


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Fold an update log: per key, the row of its last batch."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


def stream_word_count_batch(
    lines: DataFrame, path: str, checkpoint: str, column: str = "line", **run_options
) -> StreamingQuery:
    """Word counts of every batch by itself, nothing carried over."""
    return run(lines, batch_writer(path, lambda batch: word_count(batch, column)), checkpoint, **run_options)


# A restart from the checkpoint is what every run does.
stream_recoverable = run


def running_count(logs: DataFrame, key: str = "response_code") -> DataFrame:
    """Count per key over all time; run it in update mode."""
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def _windowed(events: DataFrame, length: str, slide: str, delay: str, ts: str, *keys: str | Column):
    return events.withWatermark(ts, delay).groupBy(F.window(ts, length, slide).alias("window"), *keys)


def _flat(counts: DataFrame) -> DataFrame:
    rest = [c for c in counts.columns if c != "window"]
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *rest)


def window_count(
    events: DataFrame, *keys: str, ts: str = "ts", delay: str = "1 hour", length: str = COUNT_WINDOW,
    slide: str = COUNT_SLIDE,
) -> DataFrame:
    """Count per window and key; without keys, of all events."""
    return _flat(_windowed(events, length, slide, delay, ts, *keys).agg(F.count(F.lit(1)).alias("cnt")))


def stream_window_count(logs: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    return window_count(logs, "ip_address", ts=ts, delay=delay)


def stream_value_window(events: DataFrame, value: str, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    return window_count(events, value, ts=ts, delay=delay)


def stream_count_window(events: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    return window_count(events, ts=ts, delay=delay)


def sum_and_count(logs: DataFrame, ts: str = "ts", delay: str = "1 hour", length: str = STATE_INTERVAL) -> DataFrame:
    """Bytes and requests per address and interval, as one aggregation."""
    sums = _windowed(logs, length, length, delay, ts, "ip_address").agg(
        F.sum("content_size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("requests")
    )
    return _flat(sums)


def pane_measures(logs: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The state behind the four reports: per pane, address, endpoint and status the sums they need.

    A pane is as long as the step of the windows, so that an event is counted once; two panes make a window. A pane stays
    open as long as the last window that has it, so a late event is in both its windows or in none.
    """
    sums = _windowed(
        logs, REPORT_SLIDE, REPORT_SLIDE, f"{delay} {REPORT_SLIDE}", ts, "ip_address", "endpoint", "response_code"
    ).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("content_size").cast("bigint").alias("bytes"),
        F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size"),
    )
    return _flat(sums)


def window_measures(panes: DataFrame) -> DataFrame:
    """The measures of panes in each of their windows: the one that starts with the pane and the one that ends with it."""
    step = F.expr(f"INTERVAL {REPORT_SLIDE}")
    earlier = F.struct((F.col("start") - step).alias("start"), F.col("end").alias("end"))
    later = F.struct(F.col("start").alias("start"), (F.col("end") + step).alias("end"))
    rest = [c for c in panes.columns if c not in ("start", "end")]
    return panes.select(F.explode(F.array(earlier, later)).alias("window"), *rest).select("window.*", *rest)


def window_reports(measures: DataFrame) -> dict[str, DataFrame]:
    """The four access log reports of each window that has events."""
    window = ["start", "end"]
    total = F.sum("requests").cast("bigint").alias("total")
    content = measures.groupBy(*window).agg(
        F.expr("sum(bytes) div sum(requests)").alias("avg_size"), F.min("min_size").alias("min_size"),
        F.max("max_size").alias("max_size"),
    )
    status = measures.groupBy(*window, "response_code").agg(total)
    ips = measures.groupBy(*window, "ip_address").agg(total).where(F.col("total") > access_log.IP_MORE_THAN)
    endpoints = measures.groupBy(*window, "endpoint").agg(total)
    best = F.col("total")
    return {
        "content": content,
        "status": topk_per_group(status, window, -F.col("response_code"), [], access_log.STATUS_ROWS).drop("rank"),
        "ips": topk_per_group(ips, window, best, ["ip_address"], access_log.IP_ROWS).drop("rank"),
        "endpoints": topk_per_group(endpoints, window, best, ["endpoint"], access_log.ENDPOINT_ROWS).drop("rank"),
    }


def stream_window_sql(
    logs: DataFrame, path: str, checkpoint: str, ts: str = "ts", delay: str = "1 hour", **run_options
) -> StreamingQuery:
    """The measures of panes behind the reports as they change, below ``path``; `read_reports` makes the reports of them."""
    return run(pane_measures(logs, ts, delay), batch_writer(path), checkpoint, mode="update", **run_options)


def read_reports(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four reports of all windows so far, those that are still open included."""
    updates = spark.read.parquet(path)
    measures = latest(updates, ["start", "end", "ip_address", "endpoint", "response_code"])
    return window_reports(window_measures(materialize(measures, "pane-measures")))


def stream_ad_cube(
    lines: DataFrame, path: str, checkpoint: str, column: str = "line", batch_time: Column | None = None, **run_options
) -> StreamingQuery:
    """Parse, keep advertising records, cube each batch and add it to the stored counters. Empty batches add nothing."""
    upsert = sink_counter_upsert(path, [*AD_FIXED, *AD_DIMENSIONS], batch_time=batch_time)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            upsert(ad_cube(batch), batch_id)

    return run(read_ad_log(lines, column), write, checkpoint, **run_options)


def joined_streams(
    left: DataFrame, right: DataFrame, key: str, ts: str = "ts", delay: str = "1 hour", within: str = STATE_INTERVAL
) -> DataFrame:
    """Stream-stream join of two sides on a key and closeness in time; state older than the watermark is let go."""
    a = left.withWatermark(ts, delay).alias("a")
    b = right.withWatermark(ts, delay).alias("b")
    near = (F.col(f"b.{ts}") >= F.col(f"a.{ts}")) & (F.col(f"b.{ts}") < F.col(f"a.{ts}") + F.expr(f"INTERVAL {within}"))
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & near)

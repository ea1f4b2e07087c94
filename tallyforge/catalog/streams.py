"""Streaming jobs over whole tables.

The rows come as files in three parts, one after another; after each part the job is started from its checkpoint, works
off what is new and ends. So every query here is restarted twice, and must not count anything twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.logs import _ADS, _CUBE_DIMS, _CUBE_SHOWN, _LOGS, ad_lines
from tallyforge.catalog.registry import query, table
from tallyforge.functions.weblogs import parse_access_log
from tallyforge.plans.durable import new_folder
from tallyforge.functions.adlogs import read_ad_log
from tallyforge.sources.sinks import read_counters, sink_print
from tallyforge.sources.streams import KAFKA_SCHEMA, message_lines, source_parquet_files, stream_source
from tallyforge.streaming import jobs, panes, states

_TEN_DAYS = "least(floor((day(ts) - 1) / 10), 2)"
_DELAY = "1 hour"


def replay(spark: SparkSession, rows: DataFrame, part: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Write the parts (0, 1, 2) of the rows in order, running the job after each."""
    folder = new_folder(spark, "stream-in")
    for number in range(3):
        rows.where(F.expr(part) == number).write.mode("append").parquet(folder)
        start(source_parquet_files(spark, folder, rows.schema)).awaitTermination()


def update_log(spark, rows, part, transform, keys: list[str]) -> DataFrame:
    """Run an aggregation in update mode and fold its update log."""
    out, checkpoint = new_folder(spark, "stream-out"), new_folder(spark, "stream-state")
    write = jobs.batch_writer(out)
    replay(spark, rows, part, lambda stream: jobs.run(transform(stream), write, checkpoint, mode="update"))
    return jobs.latest(spark.read.parquet(out), keys)


def timed_lines(spark, folder):
    lines = fx.fixture(spark, folder, fx.ACCESS_LINES)
    return lines.withColumn("ts", F.col("ts").cast("timestamp"))


def parsed(stream: DataFrame) -> DataFrame:
    return parse_access_log(stream, keep=("ts",))


def shown(df: DataFrame) -> DataFrame:
    """Window bounds as text."""
    return df.select(*[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c in ("start", "end") else F.col(c) for c in df.columns
    ])


def _windows(source: str, length: int, slide: int) -> str:
    starts = ", ".join(f"s - {i * slide}" for i in range(-(-length // slide)))
    return f"""w AS (SELECT *, make_timestamp(start_s * 1000000) AS start, make_timestamp((start_s + {length}) * 1000000) AS "end"
FROM (SELECT *, unnest([{starts}]) AS start_s
      FROM (SELECT *, (epoch_us(ts) // 1000000 // {slide} * {slide})::BIGINT AS s FROM {source}))
WHERE epoch_us(ts) < (start_s + {length}) * 1000000)"""


_SHOWN = """strftime(start, '%Y-%m-%d %H:%M:%S') AS start, strftime("end", '%Y-%m-%d %H:%M:%S') AS "end\""""


@query("stream_word_count_batch", r"""
WITH lines AS (SELECT doc_id % 3 AS batch_id, unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents),
words AS (SELECT batch_id, unnest(CASE WHEN length(line) > 0 AND rtrim(line, ' ') = '' THEN []
                                  ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM lines)
SELECT batch_id, word, count(*) AS cnt FROM words GROUP BY ALL""")
def stream_word_count_batch(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", r"\r\n|\r|\n", -1)).alias("line"))
    out, checkpoint = new_folder(spark, "stream-out"), new_folder(spark, "stream-state")
    replay(spark, lines, "doc_id % 3", lambda stream: jobs.stream_word_count_batch(stream, out, checkpoint))
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query("stream_recoverable", "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL")
def stream_recoverable(spark, folder):
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    keys = ["user_id", "event_type"]
    return update_log(
        spark, events, _TEN_DAYS, lambda s: s.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")), keys
    )


@query("stream_running_count", f"WITH {_LOGS} SELECT response_code, count(*) AS cnt FROM logs GROUP BY 1")
def stream_running_count(spark, folder):
    return update_log(
        spark, timed_lines(spark, folder), _TEN_DAYS, lambda s: jobs.running_count(parsed(s)), ["response_code"]
    )


def sliding_counts(spark, rows, parse, *keys: str) -> DataFrame:
    """Counts per window of 30 seconds every 20, from panes of 10 that the stream keeps."""
    log = update_log(
        spark, rows, _TEN_DAYS, lambda s: panes.pane_sums(parse(s), *keys, delay=_DELAY), ["pane", *keys]
    )
    return shown(panes.windows_of_panes(log, *keys))


@query("stream_window_count", f"""
WITH {_LOGS}, {_windows('logs', 30, 20)} SELECT {_SHOWN}, ip_address, count(*) AS cnt FROM w GROUP BY ALL""")
def stream_window_count(spark, folder):
    return sliding_counts(spark, timed_lines(spark, folder), parsed, "ip_address")


@query("stream_value_window", f"""
WITH {_LOGS}, {_windows('logs', 30, 20)} SELECT {_SHOWN}, endpoint, count(*) AS cnt FROM w GROUP BY ALL""")
def stream_value_window(spark, folder):
    return sliding_counts(spark, timed_lines(spark, folder), parsed, "endpoint")


@query("stream_count_window", f"""
WITH {_windows('events', 30, 20)} SELECT {_SHOWN}, count(*) AS cnt FROM w GROUP BY ALL""")
def stream_count_window(spark, folder):
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sliding_counts(spark, events, lambda stream: stream)


@query("stream_state_by_key", f"""
WITH {_LOGS}, sized AS (SELECT response_code, ts, content_size,
  row_number() OVER (PARTITION BY response_code ORDER BY content_size DESC) AS place FROM logs)
SELECT response_code, count(*) AS cnt, count(DISTINCT day(ts)) AS days, max(content_size) AS largest,
       coalesce(max(content_size) FILTER (place = 2), -1)::BIGINT AS second
FROM sized GROUP BY 1""")
def stream_state_by_key(spark, folder):
    """A state that does not add up: requests, days of the month and the two largest sizes of every response code."""

    def fold(state, rows):
        count, days, largest, second = state or (0, 0, -1, -1)
        for day in rows["ts"].dt.day.unique():
            days |= 1 << int(day)
        second, largest = sorted([largest, second, *rows["content_size"].nlargest(2)])[-2:]
        return count + len(rows), days, int(largest), int(second)

    def transform(stream):
        rows = parsed(stream).select("response_code", "ip_address", "endpoint", "content_size", "ts")
        return states.update_state_by_key(
            rows, ["response_code"], fold, "cnt bigint, days bigint, largest bigint, second bigint", shards=8
        )

    found = update_log(spark, timed_lines(spark, folder), _TEN_DAYS, transform, ["response_code", states.SHARD])
    # At most two sizes of each shard.
    sizes = F.sort_array(F.flatten(F.collect_list(F.array("largest", "second"))), False)
    return found.where(states.LIVE).groupBy("response_code").agg(
        F.sum("cnt").cast("bigint").alias("cnt"), F.bit_count(F.bit_or("days")).cast("bigint").alias("days"),
        sizes[0].alias("largest"), sizes[1].alias("second"),
    )


@query("stream_sum_count_join", f"""
WITH {_LOGS}, {_windows('logs', 10, 10)}
SELECT {_SHOWN}, ip_address, sum(content_size)::BIGINT AS bytes, count(*) AS requests FROM w GROUP BY ALL""")
def stream_sum_count_join(spark, folder):
    lines, keys = timed_lines(spark, folder), ["start", "end", "ip_address"]
    return shown(update_log(spark, lines, _TEN_DAYS, lambda s: jobs.sum_and_count(parsed(s), delay=_DELAY), keys))


@query("stream_window_sql", f"""
WITH {_LOGS}, {_windows('logs', 20, 10)},
content AS (SELECT start, "end", sum(content_size) // count(*) AS a, min(content_size) AS b, max(content_size) AS c
            FROM w GROUP BY ALL),
status AS (SELECT start, "end", response_code AS k, count(*) AS total FROM w GROUP BY ALL),
ips AS (SELECT start, "end", ip_address AS k, count(*) AS total FROM w GROUP BY ALL HAVING count(*) > 10),
hits AS (SELECT start, "end", endpoint AS k, count(*) AS total FROM w GROUP BY ALL),
points AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY start, "end" ORDER BY total DESC, k) <= 10),
reports AS (
  SELECT 'content' AS report, start, "end", concat_ws('/', a, b, c) AS "key", 0 AS total FROM content
  UNION ALL SELECT 'status', start, "end", k::VARCHAR, total FROM status
  UNION ALL SELECT 'ips', start, "end", k, total FROM ips
  UNION ALL SELECT 'endpoints', start, "end", k, total FROM points)
SELECT report, {_SHOWN}, "key", total::BIGINT AS total FROM reports""")
def stream_window_sql(spark, folder):
    out, checkpoint = new_folder(spark, "stream-out"), new_folder(spark, "stream-state")
    replay(
        spark, timed_lines(spark, folder), _TEN_DAYS,
        lambda s: jobs.stream_window_sql(parsed(s), out, checkpoint, delay=_DELAY),
    )
    keys = {
        "content": F.concat_ws("/", "avg_size", "min_size", "max_size"), "status": F.col("response_code").cast("string"),
        "ips": F.col("ip_address"), "endpoints": F.col("endpoint"),
    }
    result, reports = None, jobs.read_reports(spark, out)
    for name, key in keys.items():
        report = reports[name]
        total = F.lit(0).cast("bigint") if name == "content" else F.col("total")
        rows = report.select(F.lit(name).alias("report"), "start", "end", key.alias("key"), total.alias("total"))
        result = rows if result is None else result.unionByName(rows)
    return shown(result)


@query("source_kafka", f"""
WITH {_ADS} SELECT query_type, os, count(*) AS cnt FROM ads GROUP BY ALL""")
def source_kafka(spark, folder):
    """Messages with the columns of a Kafka reader, taken from files, as the connector is not part of Spark itself."""
    lines = ad_lines(spark, folder)
    messages = lines.select(
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("line").cast("binary").alias("value"),
        F.lit("basic_log").alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    folder_in, out, checkpoint = (new_folder(spark, tag) for tag in ("stream-in", "stream-out", "stream-state"))
    messages.write.parquet(folder_in)
    stream = message_lines(stream_source(spark, "parquet", KAFKA_SCHEMA, path=folder_in))
    jobs.run(read_ad_log(stream), jobs.batch_writer(out), checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("query_type", "os").agg(F.count(F.lit(1)).alias("cnt"))


@query("sink_print", "SELECT count(*) AS rows_seen FROM events")
def sink_print_query(spark, folder):
    """Runs the console sink over all events; the result is how many rows it was given."""
    folder_in, checkpoint = new_folder(spark, "stream-in"), new_folder(spark, "stream-state")
    events = table(spark, folder, "events").select("event_id", "event_type")
    events.write.parquet(folder_in)
    stream = source_parquet_files(spark, folder_in, events.schema)
    started = sink_print(stream).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    seen = sum(progress["numInputRows"] for progress in started.recentProgress)
    return spark.createDataFrame([(seen,)], "rows_seen bigint")


@query("stream_ad_cube", f"""
WITH {_ADS}, cells AS (SELECT time, query_type, {_CUBE_SHOWN}, count(*) AS n FROM ads
GROUP BY time, query_type, CUBE ({', '.join(_CUBE_DIMS)}))
SELECT concat_ws(':', time, query_type, {', '.join(_CUBE_DIMS)}) AS key, sum(n)::BIGINT AS cnt FROM cells GROUP BY 1""")
def stream_ad_cube(spark, folder):
    out, checkpoint = new_folder(spark, "counters"), new_folder(spark, "stream-state")
    lines = ad_lines(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    replay(spark, lines, _TEN_DAYS, lambda s: jobs.stream_ad_cube(s, out, checkpoint))
    return read_counters(spark, out).select("key", "cnt")
